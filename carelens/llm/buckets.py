"""Comparing the members of buckets inside tasks.

A bucket's members are dealt to blocks, and each pair of blocks (a block with
itself too) is one group of bounded size. All groups together compare all pairs of
a bucket without a row per pair, and a hot bucket is as many groups as it needs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Arrays = dict[str, np.ndarray]


def dealt(members: DataFrame, member: str, block: int, bucket: str = "bucket") -> DataFrame:
    """``members`` (with ``n``, the size of the row's bucket) with columns ``_i`` and
    ``_j``, the two blocks of a group, and ``_block``, the row's own. A row goes to
    as many groups as its bucket has blocks, one if it has up to ``block`` members."""
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64(member, F.lit("deal")), blocks.cast("long")).cast("int")
    rows = members.withColumn("_block", own).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return rows.select(
        *[c for c in members.columns if c != "n"], F.least("_block", "_other").alias("_i"),
        F.greatest("_block", "_other").alias("_j"), "_block")


def grouped(
    rows: DataFrame, keys: list[str], run: Callable[[Arrays], list[tuple]], columns: list[str], schema: str
) -> DataFrame:
    """``run`` on the rows of each key, as one array per column. Groups come sorted
    through a partition, so many small ones cost little, and one group is held at a
    time. A ``run`` that holds groups itself makes the last ones' rows in ``rest``.
    Keys are numbers without nulls."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[Arrays] = []
        last: tuple | None = None
        made: list[tuple] = []

        def whole() -> Arrays:
            return held[0] if len(held) == 1 else {c: np.concatenate([h[c] for h in held]) for c in held[0]}

        for batch in batches:
            got = {c: batch[c].to_numpy() for c in batch.columns}
            n = len(batch)
            change = np.zeros(n, dtype=bool)
            for k in keys:
                change[1:] |= got[k][1:] != got[k][:-1]
            cuts = [0, *np.flatnonzero(change).tolist(), n] if n else []
            for start, end in zip(cuts, cuts[1:], strict=False):
                key = tuple(got[k][start] for k in keys)
                if held and key != last:
                    made += run(whole())
                    held = []
                held.append({c: v[start:end] for c, v in got.items()})
                last = key
            if len(made) > 5000:
                yield pd.DataFrame(made, columns=columns)
                made = []
        if held:
            made += run(whole())
        if hasattr(run, "rest"):
            made += run.rest()
        if made:
            yield pd.DataFrame(made, columns=columns)

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(task, schema)


def in_group(block: np.ndarray, i: int, j: int) -> np.ndarray:
    """Which ordered pairs of a group's rows it compares: those of its two blocks,
    each unordered pair of different rows twice, as (a, b) and (b, a)."""
    if i == j:
        return ~np.eye(len(block), dtype=bool)
    return block[:, None] != block[None, :]


def roots(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each row the least id that links lead to, itself included."""
    least = ids.copy()
    a, b = np.nonzero(linked)
    while len(a):
        new = least.copy()
        np.minimum.at(new, a, least[b])
        np.minimum.at(new, b, new[a])
        if (new == least).all():
            break
        least = new
    return least
