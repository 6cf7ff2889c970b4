"""Bounded samples of labelled rows, for fitting classifiers on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


#: Ids ranked beyond twice the wanted number.
SPARE = 100


def labelled_ids(rows: DataFrame, label: str, per_label: int) -> DataFrame:
    """(doc_id, label) of at most ``per_label`` ids of each label, those first in the
    order of a hash of the id, so reruns agree. Rows without id or label are left
    out; rows that repeat both count once.

    Each label's ids are counted (approximately, map-side), and only those are ranked
    whose hash lies in the share of all hashes that should hold twice the wanted
    number and ``SPARE`` more. So what is sorted is bounded, whatever the table's size."""
    rows = rows.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).select("doc_id", label)
    share = rows.groupBy(label).agg((F.lit(2.0 * per_label + SPARE) / F.approx_count_distinct("doc_id")).alias("share"))
    place = F.xxhash64("doc_id").cast("double") / F.lit(2.0**64) + F.lit(0.5)
    few = rows.join(share, label).where(place <= F.col("share")).select("doc_id", label).distinct()
    first = W.partitionBy(label).orderBy(F.xxhash64("doc_id"), "doc_id")
    return few.select("doc_id", label, F.row_number().over(first).alias("rank")).where(
        F.col("rank") <= per_label).select("doc_id", label)


def sample_texts(docs: DataFrame, ids: DataFrame, *columns: str | Column) -> DataFrame:
    """The chosen rows with their texts. ``ids`` holds per_label rows of each label
    at most, so it is broadcast whatever the size of ``docs``; an id that two rows
    carry brings both."""
    return docs.select("doc_id", "text", *columns).join(F.broadcast(ids), "doc_id")
