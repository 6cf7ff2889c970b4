import re

import duckdb
import pytest

from carelens.schema import SCHEMAS
from pyspark.sql import functions as F

from carelens.sources.star import clinical_from_star
from carelens.sources.tables import ClinicalTables, JdbcSource, load_tables, read_table, store_table
from conftest import SMALL


def test_all_tables_are_asked_for():
    with pytest.raises(ValueError):
        ClinicalTables(patient=None)
    with pytest.raises(AttributeError):
        ClinicalTables(**{n: None for n in SCHEMAS}).nothing


def test_a_table_is_made_once_and_only_when_used(spark):
    made = []
    df = spark.range(1)

    def maker(name):
        return lambda: made.append(name) or df

    t = ClinicalTables(**{n: maker(n) for n in SCHEMAS})
    assert made == []
    assert t.obs is df and t.obs is df
    assert made == ["obs"]


def test_only_named_folders_are_opened(spark, tmp_path):
    store_table("obs", clinical_from_star(spark, SMALL).obs, str(tmp_path / "obs"))
    kept = read_table(spark, "obs", str(tmp_path / "obs"))
    plan = kept.where("voided = 0 and concept_id in (856, 5497)")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [concept_id" in plan and "EqualTo(voided,0)" in plan


class _Database:
    """Notes the reads, and answers what is asked of a table with skewed keys by another
    engine; one table is empty."""

    #: Most rows lie at a few large keys, far from the others; one key has many rows, some none.
    KEYS = [*range(1, 200), *range(5_000_000, 5_000_800), *[77] * 150, 9_999_999_999, None, None]

    def __init__(self):
        self.read, self.calls, self.asked, self.con = self, {}, [], duckdb.connect()

    def option(self, *_):
        return self

    def jdbc(self, url, table, **options):
        if not table.startswith("("):
            self.calls[table] = options
            return None
        self.asked.append(table)
        name = re.search(r"from (\w+) where", table)[1]
        key = re.search(r"select (\w+) k", table)[1]
        self.con.execute(f"create or replace table {name} ({key} bigint)")
        if name != "users":
            self.con.executemany(f"insert into {name} values (?)", [[k] for k in self.KEYS])
        return self

    def collect(self):
        return self.con.execute(f"select * from {self.asked[-1]}").fetchall()


@pytest.mark.parametrize("name", list(SCHEMAS))
def test_every_table_is_read_in_ranges_of_equally_many_rows(name):
    database = _Database()
    JdbcSource("jdbc:any", {"user": "u"}, pieces=9).read(database, name)
    (options,) = database.calls.values()
    assert options.pop("properties") == {"user": "u"}
    conditions = options.pop("predicates")
    assert options == {}
    if name == "users":
        assert conditions == ["1 = 1"]
        return
    assert len(conditions) == 9
    counts = [database.con.execute(f"select count(*) from {name} where {c}").fetchone()[0] for c in conditions]
    total = len(database.KEYS)
    assert sum(counts) == total and max(counts) <= total / 9 + 152  # a key's rows stay together
    again = database.con.execute(f"select count(*) from {name} where {' or '.join(f'({c})' for c in conditions)}")
    assert again.fetchone()[0] == total


def test_given_cuts_are_not_asked_for():
    database = _Database()
    JdbcSource("jdbc:any", cuts={"obs": [30, 10, 30]}).read(database, "obs")
    assert database.asked == [] and database.calls["obs"]["predicates"] == [
        "encounter_id < 10 or encounter_id is null", "encounter_id >= 10 and encounter_id < 30", "encounter_id >= 30"]


def test_given_bounds_are_not_asked_for():
    database = _Database()
    JdbcSource("jdbc:any", bounds={"obs": (1, 50)}).read(database, "obs")
    assert database.asked == [] and database.calls["obs"]["upperBound"] == 51
    load_tables(database, JdbcSource("jdbc:any"))
    assert database.asked == []  # nothing is read yet


def test_concepts_are_chosen_before_lines_meet_visits(spark, tmp_path):
    """Lines that no visit needs (a part key below 0, a key of no visit, no key) are dropped
    before the join, and the rest have the concept of their visit's type."""
    lines = [(k, part, 3, 1, 7.0, 100.0) for k in (0, 1, 2, 4, 6, 8, 9, 12, 13, 14, 18, 21) for part in (0, 1, 5, 13, 40)]
    lines += [(-1, 2, 3, 1, 7.0, 100.0), (-7, 2, 3, 1, 7.0, 100.0), (1, -2, 3, 1, 7.0, 100.0), (1, None, 3, 1, 7.0, 100.0), (None, 2, 3, 1, 7.0, 100.0)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double").write.parquet(
        str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(k, 5) for k in (0, 1, 2, 4, 4, 6, 8, 9, 13, 14, 18, -7)], "o_orderkey long, o_custkey long").selectExpr(
        "*", "timestamp_ntz'2000-01-01 00:00:00' o_orderdate").write.parquet(str(tmp_path / "orders.parquet"))
    t = clinical_from_star(spark, str(tmp_path))
    types = "array(18,6,18,9,13,5,6,18,53,18,6,32,33,35,52,7,1,3,34,18)"
    flat = {"18": (1088, 5096, 1255, 1190, 23724, 23730), "13": (856, 5497), "5": (1594, 1611, 6123, 1982, 1279, 1600, 6224),
            "6": (856, 1410, 1255, 1190, 5356, 1982, 1600, 1279, 6257, 23758, 6277, 23761, 6128, 6122, 6129, 23730),
            "53": (1190, 1255, 23891, 23779, 1030, 1040, 856, 5272, 6129, 1611, 6224), "52": (23865, 23866)}
    visits = spark.read.parquet(str(tmp_path / "orders.parquet")).selectExpr("o_orderkey", f"element_at({types}, cast(o_orderkey % 20 as int) + 1) kind")
    met = visits.join(spark.read.parquet(str(tmp_path / "lineitem.parquet")), visits.o_orderkey == F.col("l_orderkey")).collect()
    want = [(r["o_orderkey"], flat[str(r["kind"])][r["l_partkey"] % len(flat[str(r["kind"])])])
            for r in met if str(r["kind"]) in flat and (r["l_partkey"] or 0) >= 0 and r["l_partkey"] is not None]
    found = [(r["encounter_id"], r["concept_id"]) for r in t.obs.collect()]
    assert [f for f in found if f in set(want)] and not set(want) - set(found)
    assert len(found) == len(want) + 2  # the two odd part keys of visit 1
    # the choice is made on the lines' side, beneath the exchange
    plan = t.obs.where("concept_id = 856")._jdf.queryExecution().optimizedPlan().toString()
    assert "856" in plan.split("Join")[1]
