"""Joins and row multiplicities that hold up when one key has a huge share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from carelens.sources.scratch import stored

# A key with more rows than this is cut into pieces of about this many rows.
HOT_ROWS = 1_000_000

# A key with more combinations than the square of this is cut into tiles of about
# so many rows of each side.
TILE_ROWS = 1024
# Pieces that the combinations of a key are dealt to at most, at each join.
_MOST_PIECES = 1 << 20

# Rows are repeated in runs, and these in stretches, of this many.
_RUN = 1024


def tally(df: DataFrame, *columns: str, n: str = "n") -> DataFrame:
    """Distinct rows with their multiplicity: a bag, pre-aggregated before any
    shuffle, from which ``repeat_rows`` gives back every copy."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(n))


def times(*counts: str) -> Column:
    """Rows a left join would give: the product of the multiplicities, where no
    match still leaves one row."""
    return F.expr(" * ".join(f"coalesce({c}, 1L)" for c in counts))


def repeat_rows(df: DataFrame, n: Column) -> DataFrame:
    """Each row ``n`` times (none for 0). The runs of a row are dealt to all
    tasks before they are written out, so no task makes all copies of a row; their
    number is fixed, for a run is small and its rows are not, and tasks that look
    small would be joined. The longest array is a run, or has an entry per million
    copies."""
    columns = df.columns
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stretches = F.expr(f"sequence(0L, (_n - 1) div {_RUN * _RUN})")
    runs = F.expr(
        f"sequence(_stretch * {_RUN}, least(_stretch * {_RUN} + {_RUN - 1}, (_n - 1) div {_RUN}))"
    )
    run = F.expr(f"sequence(1L, least({_RUN}L, _n - _run * {_RUN}))")
    return (
        df.withColumn("_n", n.cast("long"))
        .where(F.col("_n") > 0)
        .withColumn("_stretch", F.explode(stretches))
        .withColumn("_run", F.explode(runs))
        .repartition(tasks, F.xxhash64(*columns), "_run")
        .withColumn("_copy", F.explode(run))
        .select(columns)
    )


def spread_join(
    many: DataFrame,
    one: DataFrame,
    key: str,
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """``many`` joined with ``one`` on ``key``, where ``many`` may hold a large
    part of its rows under one key. ``how`` is inner or left (keeps all of
    ``many``); the rows are those of a plain join whatever ``hot_rows`` is.

    The rows of a hot key are dealt to ``ceil(rows / hot_rows)`` pieces by a
    hash of the whole row, and the matching rows of ``one`` are copied to each
    piece; other keys have a single piece. The list of hot keys has at most
    ``rows of many / hot_rows`` entries, which is what makes it fit a
    broadcast. Give ``many`` as distinct rows (``tally`` or ``distinct``): equal
    rows fall in one piece, and unless ``how`` is left the exchange of that
    aggregate is reused by the count. Where ``many`` was already joined to
    something unique, ``counted`` is the frame before that, with as many rows.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"a spread join is inner or left, not {how}")
    if how != "left":
        many = many.where(f"{key} is not null")
    columns = [c for c in many.columns if c != key]
    hot = F.broadcast(
        (many if counted is None else counted)
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(f"_rows > {hot_rows} and {key} is not null")
        .selectExpr(key, f"cast(ceil(_rows / {hot_rows}) as bigint) _pieces")
    )
    # a missing key matches nothing, so its rows may lie anywhere
    piece = f"""case when {key} is null then xxhash64({', '.join(columns)})
                else pmod(xxhash64({', '.join(columns)}), coalesce(_pieces, 1L)) end"""
    dealt = many.join(hot, key, "left").selectExpr(key, *columns, f"{piece} _piece")
    copied = one.join(hot, key, "left").selectExpr(
        *one.columns, "explode(sequence(0L, coalesce(_pieces, 1L) - 1L)) _piece"
    )
    return dealt.join(copied, [key, "_piece"], how).drop("_piece")


def product_join(
    one: DataFrame, sides: list[tuple[DataFrame, str]], key: str, tile_rows: int = TILE_ROWS
) -> DataFrame:
    """``one`` (one row per key) joined on ``key`` with every side, each an inner or a
    left join: all combinations of a key's rows. The rows are those of plain
    joins one after the other, whatever ``tile_rows`` is; sides have distinct rows
    and no column name in common but the key.

    The combinations of one key may be far more than its rows, and are not left to one
    task. The sides are written once, in one pass, and a key's rows in each
    are counted there. At each join the combinations so far and the new side's rows are
    dealt to pieces of ``tile_rows`` by a hash of the row, the piece numbers are
    crossed, and what meets is a tile: key, piece and piece. A key without very many
    combinations has a single tile. Tiles go to a fixed number of tasks, for the
    rows that a tile takes in say nothing about those it gives. Where no key has very
    many combinations, the joins are plain ones of the written sides."""
    names = [c for side, _ in sides for c in side.columns if c != key]
    if len(set(names)) < len(names) or set(names) & set(one.columns):
        raise ValueError("the sides of a product need column names of their own")
    if any(how not in ("inner", "left") for _, how in sides):
        raise ValueError("a side of a product joins inner or left")
    spark = one.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = [side.where(f"{key} is not null").withColumn("_side", F.lit(i)) for i, (side, _) in enumerate(sides)]
    held = stored(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged), "sides", "_side")

    counts = held.groupBy(key).agg(*[F.expr(f"count_if(_side = {i}) _c{i}") for i in range(len(sides))])
    before = ["1D"]
    for i in range(len(sides)):
        before.append(f"{before[-1]} * greatest(_c{i}, 1L)")
    pieces = "cast(least(ceil(({}) / {}), {}) as bigint)"
    hot = counts.where(f"{before[-1]} > {tile_rows * tile_rows}").selectExpr(
        key,
        *[f"{pieces.format(before[i], tile_rows, _MOST_PIECES)} _l{i}" for i in range(len(sides))],
        *[f"{pieces.format(f'greatest(_c{i}, 1L)', tile_rows, _MOST_PIECES)} _r{i}" for i in range(len(sides))],
    )
    if hot.isEmpty():
        joined = one
        for i, (side, how) in enumerate(sides):
            joined = joined.join(held.where(f"_side = {i}").select(side.columns), key, how)
        return joined
    numbers = hot.columns[1:]
    joined = one.join(hot, key, "left")
    for i, (side, how) in enumerate(sides):
        left, right = f"coalesce(_l{i}, 1L)", f"coalesce(_r{i}, 1L)"
        own = [c for c in joined.columns if c not in numbers]
        mine = [c for c in side.columns if c != key]
        dealt = joined.withColumn("_i", F.expr(f"pmod(xxhash64({', '.join(own)}, {i}), {left})")).withColumn(
            "_j", F.explode(F.expr(f"sequence(0L, {right} - 1L)")))
        rows = held.where(f"_side = {i}").select(key, *mine).join(hot.select(key, f"_l{i}", f"_r{i}"), key, "left")
        rows = rows.withColumn("_j", F.expr(f"pmod(xxhash64({', '.join(mine)}), {right})")).withColumn(
            "_i", F.explode(F.expr(f"sequence(0L, {left} - 1L)"))).select(key, "_i", "_j", *mine, F.lit(True).alias("_hit"))
        tile = [key, "_i", "_j"]
        joined = dealt.repartition(tasks, *tile).join(rows.repartition(tasks, *tile), tile, how)
        # a piece that the hash leaves empty has no match for anyone, which is not a missing match
        joined = joined.where(f"_hit or {right} = 1").drop("_i", "_j", "_hit")
    return joined.drop(*numbers)


def union_distinct(*branches: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), branches).distinct()


def flag_exists(df: DataFrame, ids: DataFrame, key: str, flag: str) -> DataFrame:
    """'SIM' where the key is in ``ids``, else ''."""
    marked = ids.select(key).distinct().withColumn("_in", F.lit(True))
    return (
        df.join(marked, key, "left")
        .withColumn(flag, F.when(F.col("_in"), F.lit("SIM")).otherwise(F.lit("")))
        .drop("_in")
    )
