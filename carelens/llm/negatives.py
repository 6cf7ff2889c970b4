"""Operator 11, hard negatives by STR-packed R-trees.

Vectors are tiled by sort-tile-recursive packing: cuts from a bounded sample divide all of
them by their most varied coordinates, and each tile becomes one stored row, an R-tree
whose leaves are packed the same way. A box of least and greatest coordinates gives an
interval of the inner products that an anchor can have with what it holds, coordinate by
coordinate. Each block of anchors searches each tile: a best-first queue takes boxes by
their greatest possible score, leaves out those outside the score windows, and ends with the
first that lies strictly below the last score wanted. Tiles and blocks are rows of
bounded size that meet by number, and what a search returns is a few rows for each
anchor and tile; a window over them keeps the first.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from carelens.llm.common import stored

POSITIVES, NEGATIVES = 5, 3
#: Vectors of a tile, anchors of a block, vectors of a leaf, and children of an inner box.
TILE, ANCHORS, LEAF, FAN = 8192, 1024, 128, 8
#: Vectors of each length from which cuts are taken; every vector is indexed.
SAMPLE = 20_000
#: Components, as whole numbers, lie below this, so that scores fit a long.
LARGEST = 1 << 24
#: Tasks that searches are dealt to at most.
MOST_TASKS = 20_000
#: Windows of an anchor without so many positives hold nothing.
NOTHING = (1, 0)


# ---- packing ----


def str_cuts(rows: np.ndarray, tiles: int) -> list | None:
    """Nested cuts that divide rows into about so many tiles: each level cuts by one
    coordinate, those that vary most first, into equally many slices."""
    if tiles <= 1 or not len(rows):
        return None
    levels = min(rows.shape[1], max(1, int(np.ceil(np.log2(tiles)))))
    order = np.argsort(-rows.astype(np.float64).var(axis=0), kind="stable")[:levels]

    def cut(part: np.ndarray, left: list[int], tiles: int) -> list | None:
        if tiles <= 1 or not left or not len(part):
            return None
        slices = int(np.ceil(tiles ** (1 / len(left))))
        part = part[np.argsort(part[:, left[0]], kind="stable")]
        at = np.unique(part[[len(part) * i // slices for i in range(1, slices)], left[0]])
        where = np.searchsorted(at, part[:, left[0]], side="right")
        return [left[0], at, [cut(part[where == i], left[1:], -(-tiles // slices)) for i in range(len(at) + 1)]]

    return cut(rows, order.tolist(), tiles)


def tile_of(rows: np.ndarray, cuts: list | None) -> np.ndarray:
    """The number of each row's tile."""
    out, count = np.zeros(len(rows), dtype=np.int64), 0

    def place(at: np.ndarray, node: list | None) -> None:
        nonlocal count
        if node is None:
            out[at] = count
            count += 1
            return
        coordinate, cut, below = node
        where = np.searchsorted(cut, rows[at, coordinate], side="right")
        for i, child in enumerate(below):
            place(at[where == i], child)

    place(np.arange(len(rows)), cuts)
    return out


class Tree:
    """An R-tree over a tile's rows: leaves of neighbours, boxes over FAN of the level
    below, up to one root."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        order = np.argsort(tile_of(rows, str_cuts(rows, -(-len(rows) // LEAF))), kind="stable")
        self.ids, self.labels = ids[order], labels[order]
        self.exact = float if rows.shape[1] * max(1, int(np.abs(rows).max(initial=0))) ** 2 < 1 << 52 else np.int64
        self.rows = rows[order].astype(self.exact)
        starts = np.arange(0, len(ids), LEAF)
        low, high = np.minimum.reduceat(self.rows, starts), np.maximum.reduceat(self.rows, starts)
        self.cut = [*starts.tolist(), len(ids)]
        lows, highs, self.below, first = [low], [high], [None] * len(low), 0
        while len(low) > 1:
            at = np.arange(0, len(low), FAN)
            self.below += [range(first + a, first + min(a + FAN, len(low))) for a in at.tolist()]
            first += len(low)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            lows.append(low)
            highs.append(high)
        self.low, self.high = np.concatenate(lows), np.concatenate(highs)

    def intervals(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each anchor and box the least and greatest inner product that a row in
        it may have: each coordinate takes the side of the box that its sign asks for."""
        plus, minus = np.maximum(anchors, 0).astype(self.exact), np.minimum(anchors, 0).astype(self.exact)
        return plus @ self.low.T + minus @ self.high.T, plus @ self.high.T + minus @ self.low.T

    def search(self, anchor: np.ndarray, low: np.ndarray, high: np.ndarray, fits: Callable[[slice], np.ndarray],
               windows: list[tuple], most: int) -> list[list[tuple[int, int]]]:
        """For each window (least and greatest score) the first ``most`` rows that fit,
        as (-score, id), best first. ``low`` and ``high`` are the boxes' intervals."""
        found: list[list[tuple[int, int]]] = [[] for _ in windows]
        floor = [least for least, _ in windows]
        open_ = [i for i, (least, top) in enumerate(windows) if least <= top]
        if not open_:
            return found
        anchor, root = anchor.astype(self.exact), len(self.below) - 1
        queue = [(-high[root], root)]
        while queue:
            top, box = heapq.heappop(queue)
            if -top < min(floor[i] for i in open_):
                break
            here = [i for i in open_ if -top >= floor[i] and low[box] <= windows[i][1]]
            if not here:
                continue
            if self.below[box] is not None:
                for child in self.below[box]:
                    heapq.heappush(queue, (-high[child], child))
                continue
            part = slice(self.cut[box], self.cut[box + 1])
            score, fit = self.rows[part] @ anchor, fits(part)
            for i in here:
                at = np.flatnonzero(fit & (score >= floor[i]) & (score <= windows[i][1]))
                if len(at):
                    first = np.lexsort((self.ids[part][at], -score[at]))[:most]
                    new = zip((-score[at[first]]).tolist(), self.ids[part][at[first]].tolist(), strict=True)
                    found[i] = sorted(found[i] + [(int(s), d) for s, d in new])[:most]
                    if len(found[i]) == most:
                        floor[i] = max(floor[i], -found[i][-1][0])
        return found


# ---- in Spark ----


def taking_part(vectors: DataFrame) -> DataFrame:
    """own (a number of the row), vec_id, label, dim and q (components as whole
    numbers) of the rows that take part, stored; rows that are wholly equal are one."""
    x = F.transform("embedding", lambda c: F.floor(F.lit(256.0) * c.cast("double")))
    raw = F.transform("embedding", lambda c: c.cast("double") * 256)
    fine = F.forall(raw, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST)) & (F.size("embedding") > 0)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), x.cast("array<int>").alias("q"))
    return stored(rows.distinct().select("*", F.size("q").alias("dim"), F.monotonically_increasing_id().alias("own")), "vectors")


def images(rows: DataFrame, keys: list[str], fields: dict[str, str]) -> DataFrame:
    """One row per key: each field's values as bytes, in the order of ``own``."""
    schema = ", ".join([f"{k} bigint" for k in keys] + [f"{f} binary" for f in fields])

    def image(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("own")
        made = {
            f: [np.stack(group[f].to_numpy()).astype(kind).tobytes() if isinstance(group[f].iloc[0], (np.ndarray, list))
                else group[f].to_numpy().astype(kind).tobytes()] for f, kind in fields.items()}
        return pd.DataFrame(dict(zip(keys, ([k] for k in key), strict=True)) | made)

    return rows.groupBy(*keys).applyInPandas(image, schema)


def tiles(rows: DataFrame) -> DataFrame:
    """Every row in one tile's image: dim, tile, ids, labels and q, stored. A tile with more
    rows than its size (equal vectors can't be cut) is dealt to several by row."""
    sizes = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(1000).collect()}
    cuts = {}
    for dim, n in sizes.items():
        if n > TILE:
            some = rows.where(F.col("dim") == dim).orderBy(F.xxhash64("own"), "own").limit(SAMPLE).select("q").collect()
            cuts[dim] = str_cuts(np.array([r["q"] for r in some]), -(-n // TILE))
    known = rows.sparkSession.sparkContext.broadcast(cuts)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, at in batch.groupby("dim").indices.items():
                part = batch.iloc[at]
                yield part.assign(region=tile_of(np.stack(part["q"].to_numpy()), known.value.get(dim)))

    placed = stored(rows.mapInPandas(place, "vec_id bigint, label bigint, q array<int>, dim int, own bigint, region bigint"), "placed")
    parts = placed.groupBy("dim", "region").agg(F.ceil(F.count("*") / TILE).alias("parts"))
    dealt = placed.join(parts, ["dim", "region"]).withColumn("piece", F.pmod(F.xxhash64("own"), F.col("parts")))
    made = images(dealt, ["dim", "region", "piece"], {"vec_id": "<i8", "label": "<i8", "q": "<i4"})
    return stored(made.withColumn("tile", F.monotonically_increasing_id()), "tiles")


def numbered(found: DataFrame, number: str) -> tuple[DataFrame, dict[int, int]]:
    """A table of images with their numbers from 0 for each length, and how many each has."""
    counts = {r["dim"]: r["count"] for r in found.groupBy("dim").count().collect()}
    order = W.partitionBy("dim").orderBy(number)
    return found.withColumn("at", F.row_number().over(order) - 1).drop(number), counts


def meeting(tiles: DataFrame, blocks: DataFrame, task: Callable, schema: str) -> DataFrame:
    """``task`` on each pair of a tile and a block of one length. The numbers alone are
    ranked and paired; each side's images are then sent to the pairs by number."""
    tile_no, n_tiles = numbered(tiles.select("dim", "tile"), "tile")
    sides = tiles.join(numbered(tiles.select("dim", "tile", F.col("tile").alias("key")), "key")[0], ["dim", "tile"])
    others = blocks.groupBy("dim").agg(F.count("*").alias("n_blocks"))
    totals = tile_no.groupBy("dim").agg(F.count("*").alias("n_tiles"))
    pairs = sum(n_tiles.get(r["dim"], 0) * r["n_blocks"] for r in others.collect())
    tasks = int(min(MOST_TASKS, max(1, pairs)))
    left = sides.join(others, "dim").select(
        "dim", "at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("block"),
        *[F.col(c).alias(f"t_{c}") for c in ("vec_id", "label", "q")])
    right = blocks.join(totals, "dim").select(
        "dim", F.explode(F.sequence(F.lit(0), (F.col("n_tiles") - 1).cast("int"))).alias("at"), *[c for c in blocks.columns if c != "dim"])
    keys = ["dim", "block", "at"]
    return left.repartition(tasks, *keys).join(right.repartition(tasks, *keys), keys).drop("at", "block").mapInPandas(task, schema)


def opened(pair) -> tuple[Tree, np.ndarray, np.ndarray, np.ndarray]:
    """The tree of a pair's tile, and its anchors' own numbers, ids and labels with vectors."""
    tree = Tree(np.frombuffer(pair.t_vec_id, "<i8"), np.frombuffer(pair.t_label, "<i8"),
                np.frombuffer(pair.t_q, "<i4").astype(np.int64).reshape(-1, pair.dim))
    who = np.column_stack([np.frombuffer(pair.own, "<i8"), np.frombuffer(pair.vec_id, "<i8"), np.frombuffer(pair.label, "<i8")])
    rows = np.frombuffer(pair.q, "<i4").astype(np.int64).reshape(-1, pair.dim)
    return tree, who, rows, np.arange(len(who))


def blocks_of(anchors: DataFrame, *more: str) -> DataFrame:
    """Anchors dealt to blocks of each length: one image for each."""
    counts = anchors.groupBy("dim").agg(F.ceil(F.count("*") / ANCHORS).alias("blocks"))
    dealt = anchors.join(counts, "dim").withColumn("block", F.pmod(F.xxhash64("own", F.lit("block")), F.col("blocks")))
    fields = {"own": "<i8", "vec_id": "<i8", "label": "<i8", "q": "<i4"} | dict.fromkeys(more, "<i8")
    made = stored(images(dealt, ["dim", "block"], fields), "blocks")
    # a block that the hash leaves empty has no image: numbers run from 0 without gaps
    return numbered(made.withColumnRenamed("block", "key"), "key")[0].withColumn("block", F.col("at").cast("long")).drop("at")


def hard_negatives(vectors: DataFrame, every: int = 50) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``vectors`` has vec_id, label and embedding. Anchors are rows whose id is divisible
    by ``every``. Rows with a null id or label, a null or empty vector, a null or
    non-finite component or one of 65,536 or more in size take no part. Vectors of
    different lengths have no score. Wholly equal rows are one; rows that share an id are
    rows of their own, but never positives of each other. Anchors without positives, and
    positives without negatives in their window, give no rows."""
    rows = taking_part(vectors)
    index = tiles(rows)
    anchors = rows.where(F.col("vec_id") % every == 0)

    def nearest(pairs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in pairs:
            for pair in batch.itertuples():
                tree, who, rows, each = opened(pair)
                low, high = tree.intervals(rows)
                out = []
                for i in each.tolist():
                    own, vec_id, label = who[i].tolist()
                    got = tree.search(rows[i], low[i], high[i], lambda part, label=label, vec_id=vec_id: (
                        tree.labels[part] == label) & (tree.ids[part] != vec_id), [(-(1 << 62), 1 << 62)], POSITIVES)[0]
                    out += [(own, d, -s) for s, d in got]
                yield pd.DataFrame(out, columns=["own", "positive_id", "positive_score"]).astype("int64")

    found = meeting(index, blocks_of(anchors), nearest, "own bigint, positive_id bigint, positive_score bigint")
    best = W.partitionBy("own").orderBy(F.desc("positive_score"), "positive_id")
    positives = stored(found.withColumn("at", F.row_number().over(best) - 1).where(F.col("at") < POSITIVES), "positives")
    scores = positives.groupBy("own").agg(F.sort_array(F.collect_list(F.struct("at", "positive_score"))).alias("p"))
    # the windows of an anchor: least and greatest score for each positive, as one row of numbers
    bounds = []
    for i in range(POSITIVES):
        score = F.get("p.positive_score", F.lit(i))
        bounds += [F.coalesce(F.ceil(score / 2), F.lit(NOTHING[0])), F.coalesce(F.floor(score * 95 / 100), F.lit(NOTHING[1]))]
    searched = anchors.join(scores, "own").select("own", "vec_id", "label", "q", "dim", F.array(*bounds).cast("array<bigint>").alias("windows"))

    def negatives(pairs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in pairs:
            for pair in batch.itertuples():
                tree, who, rows, each = opened(pair)
                windows = np.frombuffer(pair.windows, "<i8").reshape(-1, POSITIVES, 2).tolist()
                low, high = tree.intervals(rows)
                out = []
                for i in each.tolist():
                    own, _, label = who[i].tolist()
                    got = tree.search(rows[i], low[i], high[i], lambda part, label=label: tree.labels[part] != label, windows[i], NEGATIVES)
                    out += [(own, k, d, -s) for k, one in enumerate(got) for s, d in one]
                yield pd.DataFrame(out, columns=["own", "at", "negative_id", "negative_score"]).astype("int64")

    found = meeting(index, blocks_of(searched, "windows"), negatives, "own bigint, at bigint, negative_id bigint, negative_score bigint")
    first = W.partitionBy("own", "at").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= NEGATIVES)
    told = positives.join(anchors.select("own", F.col("vec_id").alias("anchor_id")), "own").select(
        "own", F.col("at").cast("long").alias("at"), "anchor_id", "positive_id", "positive_score")
    return told.join(ranked, ["own", "at"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


ORACLE = f"""
with v as (
  select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as q
  from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, list_inner_product(a.q, b.q)::bigint as score
  from v a join v b on a.vec_id <> b.vec_id and len(a.q) = len(b.q) where a.vec_id % 50 = 0),
p as (
  select anchor_id, other_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= {POSITIVES})
select anchor_id, positive_id, (row_number() over w)::int as rank, other_id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id)
where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
window w as (partition by anchor_id, positive_id order by score desc, other_id)
qualify row_number() over w <= {NEGATIVES}
"""
