"""Per-key selection: first row by id, latest or earliest event, smallest row.

Everything here is an aggregate with a map-side part, or a ranking window with a
small rank bound, which Spark trims per task before the shuffle. No group is
ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from carelens.operators.evidence import answers, at_site
from carelens.params import ReportParams
from carelens.sources.tables import ClinicalTables, live


def first_row(df: DataFrame, key: str, row_id: str, *columns: str) -> DataFrame:
    """The live row with the smallest surrogate id of each key. Only the ids are
    summed up, which hashes; the row is then looked up by its id."""
    rows = live(df).select(key, row_id, *columns)
    least = rows.groupBy(key).agg(F.min(row_id).alias("_least"))
    found = rows.join(least.withColumnRenamed(key, "_key"), F.col(row_id) == F.col("_least"))
    return found.where(F.col(key) == F.col("_key")).select(key, *columns)


def latest(df: DataFrame, key: str, moment: str, alias: str) -> DataFrame:
    return df.groupBy(key).agg(F.max(moment).alias(alias))


def earliest(df: DataFrame, key: str, moment: str, alias: str) -> DataFrame:
    return df.groupBy(key).agg(F.min(moment).alias(alias))


def smallest_row(df: DataFrame, key: str) -> DataFrame:
    """One row per key: the smallest by all columns in order, nulls last."""
    order = [F.col(c).asc_nulls_last() for c in df.columns if c != key]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def first_second_last(df: DataFrame, key: str, moment: str, names: tuple[str, str, str]) -> DataFrame:
    """First, second distinct (else the first) and last moment of each key.

    Rows of one moment become one before any ranking, map-side already, and the one
    exchange of distinct moments feeds both the ranking and the last moment, so
    ``df`` is read once. The two results meet in an aggregate, not a join, which
    would ask the ranked side for keys that are not null and so read it again."""
    first, second, last = names
    moments = df.select(key, moment).distinct()
    order = Window.partitionBy(key).orderBy(F.col(moment))
    ranked = moments.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= 2)
    none = F.lit(None).cast(df.schema[moment].dataType)
    early = ranked.select(
        key,
        F.when(F.col("_rank") == 1, F.col(moment)).alias(first),
        F.when(F.col("_rank") == 2, F.col(moment)).alias(second),
        none.alias(last),
        F.lit(None).cast("long").alias("_n"),
    )
    # the number of moments needs them distinct, so the optimizer keeps the exchange
    late = moments.groupBy(key).agg(F.max(moment).alias(last), F.count(F.lit(1)).alias("_n")).select(
        key, none.alias(first), none.alias(second), last, "_n"
    )
    found = early.unionByName(late).groupBy(key).agg(*[F.max(n).alias(n) for n in (*names, "_n")])
    middle = F.when(F.col("_n") > 1, F.col(second)).otherwise(F.col(first))
    return found.select(key, first, middle.alias(second), last)


def answers_by_moment(
    t: ClinicalTables,
    concepts: tuple[int, ...],
    *by: str,
    site: ReportParams | None = None,
    **measures: str,
) -> DataFrame:
    """Live answers summed up per patient and moment, and ``by`` (expressions
    that end in a name). The measures are SQL aggregates.

    Reports look up values "recorded at that patient's latest moment". Both
    sides of that look-up are keyed on (patient, moment), so the answers of one
    very frequent patient are spread over many tasks, and the look-up itself is
    a join to a side that is already unique.
    """
    rows = answers(t, *concepts)
    if site is not None:
        rows = at_site(rows, site)
    named = [b.rsplit(" ", 1)[-1] for b in by]
    values = {"concept_id", "value_coded", "value_numeric", "value_datetime"} - set(named)
    shown = rows.selectExpr("person_id patient_id", "obs_datetime moment", *by, *sorted(values))
    return shown.groupBy("patient_id", "moment", *named).agg(
        *[F.expr(m).alias(name) for name, m in measures.items()]
    )


def look_up(df: DataFrame, moment: str, answers: DataFrame, how: str = "left") -> DataFrame:
    """Attach what was recorded at ``moment`` of each row's patient."""
    return df.join(answers.withColumnRenamed("moment", moment), ["patient_id", moment], how)
