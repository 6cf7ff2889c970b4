from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from carelens.operators.combine import product_join, repeat_rows, spread_join, tally, times
from carelens.operators.choose import smallest_row
from conftest import rows


def _bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_rows", [1, 7, 1000])
def test_spread_join_equals_join(spark, how, hot_rows):
    many = spark.createDataFrame(
        [(1, n) for n in range(100)] + [(n, n) for n in range(2, 30)] + [(None, 5), (None, 6)],
        "k long, v long",
    )
    one = spark.createDataFrame([(n, f"x{n}") for n in range(0, 20)] + [(1, "again")], "k long, w string")
    plain = many.join(one, "k", how).select("k", "v", "w")
    assert _bag(spread_join(many, one, "k", how, hot_rows).select("k", "v", "w")) == _bag(plain)


def test_other_spread_joins_are_refused(spark):
    df = spark.createDataFrame([(1, 1)], "k long, v long")
    with pytest.raises(ValueError):
        spread_join(df, df.select("k"), "k", "right")


@settings(max_examples=6, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 3) | st.none(), st.integers(0, 9)), min_size=1, max_size=30, unique=True),
    st.lists(st.integers(0, 4), min_size=1, max_size=6),
    st.sampled_from(["inner", "left"]),
)
def test_rows_of_a_spread_join_do_not_depend_on_the_threshold(spark, left, right, how):
    many = spark.createDataFrame(left, "k long, v long")
    one = spark.createDataFrame([(k, i) for i, k in enumerate(right)], "k long, w long")
    want = _bag(many.join(one, "k", how).select("k", "v", "w"))
    for hot_rows in (1, 3, 1000):
        assert _bag(spread_join(many, one, "k", how, hot_rows).select("k", "v", "w")) == want


def test_a_hot_key_is_cut_into_pieces_of_bounded_size(spark):
    many = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    one = many.select("k").distinct()
    joined = spread_join(many, one, "k", hot_rows=100)
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert "_piece" in plan
    # The pieces as the join deals them: 1667 rows of key 0 in 17 pieces.
    dealt = many.where("k = 0").withColumn("piece", F.pmod(F.xxhash64("v"), F.lit(17)))
    largest = dealt.groupBy("piece").count().agg(F.max("count")).first()[0]
    assert largest < 200
    assert joined.count() == 5000


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 3000), min_size=1, max_size=6))
def test_rows_are_repeated_exactly(spark, counts):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(counts)], "id long, n long")
    found = dict(repeat_rows(df, F.col("n")).groupBy("id").count().collect())
    assert found == {i: n for i, n in enumerate(counts) if n}


@pytest.mark.parametrize("n", [1, 1023, 1024, 1025, 2048, 2049, 1024 * 1024, 1024 * 1024 + 1])
def test_run_borders(spark, n):
    df = spark.createDataFrame([(n,)], "n long")
    assert repeat_rows(df, F.col("n")).count() == n


def test_copies_of_one_row_come_out_of_many_tasks(spark):
    df = spark.createDataFrame([(7, 300_000)], "id long, n long")
    made = repeat_rows(df, F.col("n")).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in made) == 300_000
    assert len(made) > 1 and max(r["count"] for r in made) < 200_000


def test_tally_and_times(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "k long, v string")
    assert rows(tally(df, "k", "v"), "k", "v", "n") == [(1, "a", 2), (1, "b", 1)]
    counts = spark.createDataFrame([(2, None), (3, 4)], "a long, b long")
    assert [r[0] for r in counts.select(times("a", "b")).collect()] == [2, 12]


def test_smallest_row_has_nulls_last(spark):
    df = spark.createDataFrame([(1, None, 1), (1, "b", 2), (1, "b", None)], "k long, a string, b long")
    assert rows(smallest_row(df, "k"), "k", "a", "b") == [(1, "b", 2)]


def _sides(spark, *lists):
    return [spark.createDataFrame(rows, f"k long, {name} long") for rows, name in zip(lists, "abc", strict=False)]


@settings(max_examples=6, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 3) | st.none(), st.integers(0, 9)), max_size=25, unique=True),
    st.lists(st.tuples(st.integers(0, 4) | st.none(), st.integers(0, 9)), max_size=25, unique=True),
    st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5)), max_size=15, unique=True),
    st.sampled_from([("left", "left", "left"), ("left", "inner", "left"), ("inner", "left", "inner")]),
)
def test_rows_of_a_product_do_not_depend_on_the_tiles(spark, a, b, c, hows):
    one = spark.createDataFrame([(k, k) for k in range(6)] + [(None, 9)], "k long, v long")
    sides = _sides(spark, a, b, c)
    want = one
    for side, how in zip(sides, hows, strict=True):
        want = want.join(side, "k", how)
    want = _bag(want.select("v", "a", "b", "c"))
    for tile_rows in (1, 2, 1024):
        assert _bag(product_join(one, list(zip(sides, hows, strict=True)), "k", tile_rows).select("v", "a", "b", "c")) == want


def test_a_product_needs_names_of_its_own(spark):
    one = spark.createDataFrame([(1, 1)], "k long, v long")
    for sides in ([(one, "left")], [(one.select("k"), "right")], [(one.toDF("k", "a"), "left"), (one.toDF("k", "a"), "left")]):
        with pytest.raises(ValueError):
            product_join(one, sides, "k")


def test_combinations_of_a_hot_key_go_to_all_tasks(spark):
    """300 x 200 x 3 rows of key 0, of which no task makes more than a few tiles."""
    lists = [[(0, i) for i in range(n)] + [(k, k) for k in range(1, 40)] for n in (300, 200, 3)]
    one = spark.range(40).select(F.col("id").alias("k"), F.col("id").alias("v"))
    made = product_join(one, [(s, "left") for s in _sides(spark, *lists)], "k", 10)
    per_task = made.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 300 * 200 * 3 + 39
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(per_task) == tasks and max(r["count"] for r in per_task) < 1.2 * 300 * 200 * 3 / tasks
