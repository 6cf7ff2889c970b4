"""Operator 8, mixing sources to target weights.

Sizes are summed up per source (map-side first, so a hot source costs no more
than others), each source gets a target and a repetition rate, and a document is
taken floor(rate) times plus once more with the probability of the fraction,
drawn from a hash of its id. Only built-in functions run. The rates are one row
per source: up to ``BROADCAST_SOURCES`` of them are broadcast, so that documents
are not shuffled; more are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from carelens.llm.common import WORD, packed, stored, text_of

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: A source is never repeated more often than this.
MOST_REPEATS = 3
SEED = "mix-1"
#: Sources whose rates are broadcast.
BROADCAST_SOURCES = 10_000


def word_count(text: Column) -> Column:
    """Words as runs of anything but ASCII white space; 0 for null."""
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number from 0 up to 1 that depends on the id and the seed alone."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS
) -> DataFrame:
    """(source, source_size) with a weight and a target for each source.

    The targets share the sum of all sizes by weight. A target stops at ``most``
    times the source's size and the excess goes to the others by weight, until
    none is above. Sources are ordered by how early they reach their stop: when
    the first k have, the others share what is left, and the first source that
    this share does not lift to its stop sets the level of all after it. The
    windows run over one row per source."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    sizes = sizes.withColumn("place", F.row_number().over(order) - 1)
    sizes = sizes.withColumn("weight", F.element_at(cycle, F.col("place") % len(weights) + 1))
    sizes = sizes.withColumn("stop", (F.col("source_size") * most).cast("long"))
    early = W.orderBy(F.col("stop") / F.col("weight"), "place")
    before, rest = early.rowsBetween(W.unboundedPreceding, -1), early.rowsBetween(0, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("stop").over(before), F.lit(0))
    sizes = sizes.withColumn("share", left.cast("double") / F.sum("weight").over(rest).cast("double"))
    free = F.col("share") * F.col("weight") <= F.col("stop")
    # shares grow from one stopped source to the next, so the first free one has the least free share
    level = F.first(F.when(free, F.col("share")), ignorenulls=True).over(
        early.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    target = F.least(F.col("stop").cast("double"), F.coalesce(level, F.lit(0.0)) * F.col("weight"))
    return sizes.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    size: Column | None = None,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_REPEATS,
    seed: str = SEED,
) -> DataFrame:
    """``row`` (the input row), size, source_size, target and copies of every document.

    ``docs`` has doc_id, source and, unless ``size`` is given, text. Null sources
    are one source, the last. Empty and null texts have size 0; a source of
    nothing else has target 0 and none of its documents is taken. Rows that
    repeat a doc_id share its draw. Reruns give the same copies."""
    rows = packed(docs, doc_id=F.col("doc_id"), source=F.col("source"),
                  size=word_count(F.col("text")) if size is None else size.cast("long"))
    targets = stored(
        source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
        .withColumnRenamed("source", "of_source"), "targets")
    if targets.count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    extra = (draw(F.col("doc_id"), seed) < rate - F.floor(rate)).cast("long")
    return rows.join(targets, F.col("source").eqNullSafe(F.col("of_source")), "left").select(
        "row", "size", "source_size", "target", (F.floor(rate) + extra).cast("long").alias("copies")
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the input's
    columns. An empty table gives an empty one."""
    taken = mix(docs, **options).where(F.col("copies") > 0)
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def mixing_digest(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, size, source_size, target and the words taken."""
    return mix(docs.select("doc_id", "source", "text")).select(
        "row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


ORACLE = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
  from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
p as (select *, row_number() over (order by source nulls last) - 1 as place from s),
w as (select *, [5, 2, 1][(place % 3 + 1)::int] as weight, source_size * 3 as stop from p),
h as (
  select *, (sum(source_size) over () - coalesce(sum(stop) over (order by stop / weight, place
      rows between unbounded preceding and 1 preceding), 0))::double
    / (sum(weight) over (order by stop / weight, place rows between current row and unbounded following))::double as share
  from w),
t as (
  select source, source_size, least(stop::double, coalesce(
    (select share from h where share * weight <= stop order by stop / weight, place limit 1), 0.0) * weight) as target
  from h),
r as (
  select doc_id, size, source_size, target,
    case when source_size > 0 then target / source_size else 0.0 end as rate,
    ('0x' || substr(md5('mix-1:' || coalesce(doc_id::varchar, 'null')), 1, 8))::bigint::double / 4294967296.0 as u
  from d join t on d.source is not distinct from t.source)
select doc_id, size, source_size, target,
  ((floor(rate) + (case when u < rate - floor(rate) then 1 else 0 end)) * size)::bigint as taken
from r
"""
