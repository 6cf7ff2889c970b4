"""Operator 5, near duplicates of embeddings by an exact metric range join.

Equal vectors are one class. The classes of a label and length are packed into rows of
some thousand vectors, which are dealt to tiles that a task can hold, and each two tiles
meet in one group. There the vectors of one tile are partitioned among pivots, in shells
by their angle to the pivot, and a vector of the other goes to each shell where something
within the radius may be at home: what a vector links with is found at its home and
nowhere else. What goes there is compared by a few coordinates that bound the cosine,
and what passes, by all. No pair becomes a row, only counts and, for each linked
vector of a group, one link of a forest. Groups run in rounds that each send about as
many bytes as all vectors have, however many tiles a label needs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.llm.common import give_back, stored
from carelens.llm.components import components

LEAST_COSINE = 0.98
#: Vectors of a tile for which one more pivot is used, and the most pivots. In spaces
#: of many dimensions more pivots cost more tests than they save comparisons.
PER_PIVOT, MOST_PIVOTS = 256, 512
#: Vectors and bytes of a tile at most, on average.
BLOCK, TILE_BYTES = 1 << 18, 3 << 24
#: Bytes of the vectors of a packed row at most, and of packed rows sent to Python together.
PACK_BYTES, SENT_BYTES = 1 << 21, 1 << 23
#: Vectors of one shell, vectors that meet a tile at once, and links verified at once.
SHELL, MEETING, LINKS = 128, 8192, 1 << 14
#: Coordinates by which vectors are compared first; what is left of their lengths is one more.
FIRST = 15
#: While a table is written: its shuffle files go as soon as it is there, and Python gets few packed rows at once.
SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(SENT_BYTES)}


def unit(rows: np.ndarray) -> np.ndarray:
    x = (rows if rows.ndim == 2 else np.stack(rows)).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small numbers stay finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable(vector: Column) -> Column:
    """Not null, with finite components that are not all zero."""
    plain = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(plain, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine & F.exists(plain, lambda x: x != 0), F.lit(False))


# ---- cells of a tile ----


def slack(dim: int) -> float:
    """More than an inner product of unit vectors in single precision can be off."""
    return 1e-5 + dim * 2.0**-23


def homes(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From inner products, a row for each pivot and a column for each vector: the
    first pivot of the greatest, and that."""
    home, own = np.zeros(at.shape[1], dtype=np.int64), at[0].copy()
    for j in range(1, len(at)):
        home[at[j] > own] = j
        np.maximum(own, at[j], out=own)
    return home, own


def reach(pivot: np.ndarray, radius: float) -> np.ndarray:
    """How much less a vector's product with one pivot may be than with another, its home."""
    off = slack(pivot.shape[1])
    apart = np.sqrt(np.maximum(2 - 2 * (pivot @ pivot.T), 0) + pivot.dtype.type(4 * off))
    return apart * pivot.dtype.type(radius + off) + pivot.dtype.type(2 * off)


def cells(u: np.ndarray, pivot: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """The home of each unit vector and the cells it goes to.

    x lies within the radius of the border between its home and j, at
    (d(x, j)^2 - d(x, home)^2) / (2 d(home, j)) from it, or beyond. With that
    d(x, j) is at most d(x, home) + 2 radius, as the triangle inequality asks."""
    at, far = pivot @ u.T, reach(pivot, radius)
    home, own = homes(at)
    return home, np.stack([at[j] >= own - far[j].take(home) for j in range(len(pivot))], axis=1)


def directions(u: np.ndarray) -> np.ndarray | None:
    """Orthonormal columns along which these unit vectors vary most, about; none in few dimensions."""
    if u.shape[1] <= FIRST + 2:
        return None
    axes = np.random.default_rng(0).normal(size=(u.shape[1], FIRST)).astype(u.dtype)
    for _ in range(3):
        axes = np.linalg.qr(u.T @ (u @ axes))[0]
    return np.linalg.qr(axes.astype(np.float64))[0].astype(u.dtype)


def shortened(u: np.ndarray, axes: np.ndarray | None) -> np.ndarray:
    """Rows whose inner products are those of ``u`` or more: coordinates along the axes
    and the length of the rest (Cauchy and Schwarz)."""
    if axes is None:
        return u
    first = u @ axes
    rest = np.maximum(1 - (first * first).sum(axis=1, keepdims=True), 0) + 8 * np.float32(slack(u.shape[1]))
    return np.hstack([first, np.sqrt(rest)])


def found_root(parent: np.ndarray, at: np.ndarray) -> np.ndarray:
    root = parent[at]
    while (parent[root] != root).any():
        root = parent[root]
    parent[at] = root
    return root


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the trees of each a and b; a tree's root is its least member."""
    while len(a):
        a, b = found_root(parent, a), found_root(parent, b)
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


class Group:
    """The links between two tiles, or within one. The first tile is held, in cells;
    vectors of the second, or its own, pass by."""

    def __init__(self, rep: np.ndarray, copies: np.ndarray, raw: np.ndarray, least: float, per_pivot: int):
        self.rep, self.copies, self.raw, self.least, self.own = rep, copies, raw, least, len(rep)
        self.n, self.parent = np.zeros(self.own, dtype=np.int64), np.arange(self.own)
        self.slack, self.per_pivot, self.near = slack(raw.shape[1]), per_pivot, None

    def deal(self) -> None:
        """Cells, their members by angle, and shells."""
        n = self.own
        self.axes = directions(unit(self.raw[:: -(-n // MEETING)]).astype(np.float32))
        few = min(MOST_PIVOTS, max(1, -(-n // self.per_pivot)))
        self.pivot = unit(self.raw[np.arange(few) * n // few]).astype(np.float32)
        self.far = reach(self.pivot, float(np.sqrt(2 - 2 * self.least)))
        home, angle, near = np.empty(n, dtype=np.int64), np.empty(n), []
        for at in range(0, n, MEETING):
            u = unit(self.raw[at : at + MEETING]).astype(np.float32)
            home[at : at + MEETING], own = homes(self.pivot @ u.T)
            angle[at : at + MEETING] = np.arccos(np.clip(own.astype(np.float64) - self.slack, -1, 1))
            near.append(shortened(u, self.axes))
        self.who = np.lexsort((angle, home))
        self.near = np.concatenate(near)[self.who]
        # a vector within the radius of another is at most that much farther from its pivot, by angles
        floor = np.cos(np.minimum(angle[self.who] + np.arccos(min(1.0, max(-1.0, self.least))), np.pi)) - 2 * self.slack
        cuts = np.searchsorted(home[self.who], np.arange(few + 1)).tolist()
        self.shells = [
            [(a, min(a + SHELL, end), np.float32(floor[min(a + SHELL, end) - 1])) for a in range(start, end, SHELL)]
            for start, end in zip(cuts, cuts[1:], strict=False)]

    def within(self) -> None:
        """Links of the held vectors with each other."""
        if self.own <= self.per_pivot:
            every = np.arange(self.own)
            self.compare(every, self.raw, every, every[:, None] < every[None, :])
            return
        self.deal()
        for at in range(0, self.own, MEETING):
            who = self.who[at : at + MEETING]
            self.meet(self.raw[who], who, at)

    def add(self, rep: np.ndarray, copies: np.ndarray, raw: np.ndarray) -> None:
        """Links of the held vectors with others."""
        if self.near is None:
            self.deal()
        at = np.arange(len(self.rep), len(self.rep) + len(rep))
        self.rep, self.copies = np.concatenate([self.rep, rep]), np.concatenate([self.copies, copies])
        self.n, self.parent = np.concatenate([self.n, np.zeros(len(rep), dtype=np.int64)]), np.concatenate([self.parent, at])
        for k in range(0, len(rep), MEETING):
            self.meet(raw[k : k + MEETING], at[k : k + MEETING])

    def meet(self, raw: np.ndarray, number: np.ndarray, place: int | None = None) -> None:
        """``number``: those of the vectors that come. ``place``: where the first of them
        stands among the held ones; each then meets only those before it."""
        u = unit(raw).astype(np.float32)
        products, near, enough = self.pivot @ u.T, shortened(u, self.axes), np.float32(self.least - 4 * self.slack)
        home, own = homes(products)
        one, other, waiting = [], [], 0
        for at, far, shells in zip(products, self.far, self.shells, strict=True):
            if not shells:
                continue
            if place is not None and shells[0][0] >= place + len(raw):
                break
            goes = np.flatnonzero(at >= np.maximum(own - far.take(home), shells[-1][2]))
            at, coming = at.take(goes), near.take(goes, axis=0)
            for start, end, floor in shells:
                part = np.flatnonzero(at >= floor) if floor > shells[-1][2] else None
                to = coming if part is None else coming.take(part, axis=0)
                if not len(to):
                    continue
                product = self.near[start:end] @ to.T
                if product.max() < enough:
                    continue
                hit = product >= enough
                who = goes if part is None else goes[part]
                if place is not None:
                    hit &= np.arange(start, end)[:, None] < place + who
                if np.count_nonzero(hit) <= SHELL:
                    a, b = np.divmod(np.flatnonzero(hit), hit.shape[1])
                    one.append(self.who[start + a])
                    other.append(who[b])
                    waiting += len(a)
                    if waiting > LINKS:
                        self.verify(np.concatenate(one), raw, np.concatenate(other), number)
                        one, other, waiting = [], [], 0
                else:
                    rows, columns = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
                    self.compare(self.who[start + rows], raw[who[columns]], number[who[columns]], hit[np.ix_(rows, columns)])
        if waiting:
            self.verify(np.concatenate(one), raw, np.concatenate(other), number)

    def verify(self, a: np.ndarray, raw: np.ndarray, b: np.ndarray, number: np.ndarray) -> None:
        """Links among some pairs."""
        yes = np.einsum("ij,ij->i", unit(self.raw[a]), unit(raw[b])) >= self.least
        a, b = a[yes], number[b[yes]]
        np.add.at(self.n, a, self.copies[b])
        np.add.at(self.n, b, self.copies[a])
        unite(self.parent, a, b)

    def compare(self, a: np.ndarray, raw: np.ndarray, b: np.ndarray, asked: np.ndarray) -> None:
        """Links between many of some vectors and of others: the pairs asked for."""
        linked = (unit(self.raw[a]) @ unit(raw).T >= self.least) & asked
        ones = linked.astype(np.float64)  # products of these are exact up to 2^53 copies
        np.add.at(self.n, a, (ones @ self.copies[b].astype(np.float64)).astype(np.int64))
        np.add.at(self.n, b, (self.copies[a].astype(np.float64) @ ones).astype(np.int64))
        some = linked.any(axis=0)
        unite(self.parent, a[linked.argmax(axis=0)[some]], b[some])
        ones = ones.astype(np.float32)
        x, y = np.nonzero(np.triu(ones @ ones.T > 0, 1))
        unite(self.parent, a[x], a[y])

    def told(self) -> list[np.ndarray]:
        """Of linked vectors: rep, the number of links, and the least rep that links lead to."""
        at = np.flatnonzero(self.n)
        root, least = found_root(self.parent, at), self.rep.copy()
        np.minimum.at(least, root, self.rep[at])
        return [self.rep[at], self.n[at], least[root]]


# ---- in Spark ----


def written(df: DataFrame, name: str) -> DataFrame:
    """``stored`` under SETTINGS."""
    conf = df.sparkSession.conf
    before = {k: conf.get(k, None) for k in SETTINGS}
    try:
        for k, v in SETTINGS.items():
            conf.set(k, v)
        return stored(df, name)
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


NUMBERS = ["k1", "k2", "rep", "copies"]


def packed_rows(classes: DataFrame, most: int) -> DataFrame:
    """label, dim, lists of k1, k2, rep and copies, and the vectors' bytes: up to PACK_BYTES
    or ``most`` vectors that a task has of a label and length."""
    schema = T.StructType([classes.schema["label"]]).add("dim", T.IntegerType())
    for c in NUMBERS:
        schema.add(c, T.ArrayType(T.LongType()))
    schema.add("vector", T.BinaryType())
    kind = number_type(classes)

    def image(label: object, dim: int, parts: list) -> tuple:
        whole = [np.concatenate(x) for x in zip(*parts, strict=True)]
        return (label, dim, *whole[:-1], whole[-1].tobytes())

    def batch_of(made: list, label: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*made, strict=True))
        kinds = [label, pa.int32(), *[pa.list_(pa.int64())] * len(NUMBERS), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], names=schema.names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        made, size, parts, held, key, kept = [], 0, [], 0, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            label, dims = batch.column("label"), batch.column("dim").to_numpy()
            kept = label.type
            change = dims[1:] != dims[:-1]
            change |= pc.not_equal(label[1:], label[:-1]).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(dims)]
            starts = np.concatenate([[0], np.cumsum(dims.astype(np.int64))])
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
            numbers = [batch.column(c).to_numpy() for c in NUMBERS]
            for start, end in zip(cuts, cuts[1:], strict=False):
                dim = int(dims[start])
                now, limit = (label[start].as_py(), dim), max(1, min(most, PACK_BYTES // (dim * kind.itemsize)))
                while start < end:
                    if parts and (now != key or held >= limit):
                        made.append(image(*key, parts))
                        size += len(made[-1][-1]) + 32 * held
                        parts, held = [], 0
                        if size > SENT_BYTES:
                            yield batch_of(made, kept)
                            made, size = [], 0
                    key, stop = now, min(end, start + limit - held)
                    parts.append([x[start:stop] for x in numbers] + [flat[starts[start] : starts[stop]]])
                    held += stop - start
                    start = stop
        if parts:
            made.append(image(*key, parts))
        if made:
            yield batch_of(made, kept)

    columns = ["label", "dim", *NUMBERS, "vector"]
    return classes.select(*columns).sortWithinPartitions("label", "dim").mapInArrow(task, schema)


def number_type(classes: DataFrame) -> np.dtype:
    return np.dtype("float32" if classes.schema["vector"].dataType.elementType == T.FloatType() else "float64")


def links_of(groups: DataFrame, kind: np.dtype, least: float, per_pivot: int) -> DataFrame:
    """rep, n and root of the linked vectors of each group. Rows are bucket, i, j (the
    group), second (whether of tile j), label, dim, rep, copies and vector."""
    keys = ["bucket", "i", "j", "label", "dim"]

    def whole(parts: list[tuple]) -> list[np.ndarray]:
        return [np.concatenate(x) for x in zip(*parts, strict=True)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        key, first, second, held, group, out, n_out = None, [], [], 0, None, [], 0

        def pass_by() -> None:
            nonlocal group, first, second, held
            if first and group is None:
                group = Group(*whole(first), least, per_pivot)
                first = []
            if second and group is not None:
                group.add(*whole(second))
            second, held = [], 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal group, out, n_out
            pass_by()
            if group is not None:
                if key[1] == key[2] and group.own > 1:
                    group.within()
                told = group.told()
                if len(told[0]):
                    out.append(told)
                    n_out += len(told[0])
                group = None
            if n_out > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(x, type=pa.int64()) for x in whole(out)], ["rep", "n", "root"])
                out, n_out = [], 0

        for batch in batches:
            for r in range(batch.num_rows):
                now = tuple(batch.column(c)[r].as_py() for c in keys)
                if key is not None and now != key:
                    yield from close()
                    first = []
                key = now
                rep, copies = (batch.column(c)[r].values.to_numpy().copy() for c in ("rep", "copies"))
                part = (rep, copies, np.frombuffer(batch.column("vector")[r].as_buffer(), kind).reshape(-1, now[-1]).copy())
                if not batch.column("second")[r].as_py():
                    first.append(part)
                    continue
                second.append(part)
                held += len(rep)
                if held >= MEETING:
                    pass_by()
        if key is not None:
            yield from close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, type=pa.int64()) for x in whole(out)], ["rep", "n", "root"])
        give_back()  # the last tiles are gone; the worker stays

    sorted_ = groups.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "label", "dim", "second")
    return sorted_.mapInArrow(task, "rep bigint, n bigint, root bigint")


def tiles_of(packs: DataFrame, size: int, block: int) -> tuple[DataFrame, int]:
    """``packs`` with bucket (a hash of label and length), tiles (how many these have) and
    tile, and the number of rounds in which all tiles meet with a pack sent about once in each."""
    most = F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.lit(TILE_BYTES) / (F.col("dim") * size))))
    sizes = written(packs.groupBy("label", "dim").agg(F.sum(F.size("rep")).alias("n")).withColumn("tiles", F.ceil(F.col("n") / most)), "sizes")
    whole = (F.col("n") * F.col("dim")).cast("double")
    once, sent = sizes.agg(F.sum(whole), F.sum(whole * F.col("tiles"))).first()
    # at most one row for each tile full of vectors
    large = F.broadcast(sizes.where("tiles > 1").select("label", "dim", "tiles"))
    number = F.pmod(F.xxhash64(F.col("k1")[0], F.col("k2")[0], F.lit("deal")), F.col("tiles"))
    dealt = packs.join(large, ["label", "dim"], "left").withColumn("tiles", F.coalesce("tiles", F.lit(1).cast("long")))
    return dealt.withColumn("bucket", F.xxhash64("label", "dim")).withColumn("tile", number), int(np.ceil((sent or 1) / (once or 1)))


def meeting(dealt: DataFrame, part: int, rounds: int) -> DataFrame:
    """Packs as often as their tiles meet another, or themselves, in a round."""
    def here(other: Column) -> Column:
        pair = F.xxhash64("bucket", F.least("tile", other), F.greatest("tile", other))
        return F.pmod(pair, F.lit(rounds).cast("long")) == part

    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1), here)
    rows = dealt.select("bucket", "tile", "label", "dim", "rep", "copies", "vector", F.explode(others).alias("other"))
    return rows.select(
        "bucket", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"),
        (F.col("tile") > F.col("other")).alias("second"), "label", "dim", "rep", "copies", "vector")


def near_vectors(vectors: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """``row`` (the input row without its vector), n_links, component_id and kept.

    ``vectors`` has vec_id, label and embedding. Rows whose id or label is null, and
    vectors that are null, empty, zero or hold null or non-finite components, link
    with nothing and are their own component. Only vectors of one label and length
    are compared. Rows that repeat an id and vector are copies of each other; rows
    of one id with different vectors share their links."""
    carried = [c for c in vectors.columns if c != "embedding"]
    fit = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding"))
    vector = F.when(fit, F.col("embedding"))
    keys = ["label", "dim", "k1", "k2"]
    rows = vectors.select(
        F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"), F.col("vec_id"), F.when(fit, F.col("label")).alias("label"),
        F.size(vector).alias("dim"), F.xxhash64(vector).alias("k1"), F.xxhash64(F.lit(1), vector).alias("k2"),
        vector.alias("vector"))
    classes = rows.where(F.col("vector").isNotNull()).groupBy(*keys).agg(
        F.min("vec_id").cast("long").alias("rep"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
    kind = number_type(classes)
    packs = written(packed_rows(classes, BLOCK), "classes")
    dealt, rounds = tiles_of(packs, kind.itemsize, BLOCK)
    found = reduce(DataFrame.union, [
        written(links_of(meeting(dealt, part, rounds), kind, least, PER_PIVOT), "found") for part in range(rounds)])
    links = found.groupBy("rep").agg(F.sum("n").alias("n"))
    forest = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    told = packs.select("label", "dim", F.inline(F.arrays_zip(*NUMBERS))).join(links, "rep", "left").join(
        forest.withColumnRenamed("node", "rep"), "rep", "left").select(
        *keys, (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"))
    return rows.select("row", "vec_id", *keys).join(told, keys, "left").select(
        "row", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"))


def embeddings_digest(vectors: DataFrame) -> DataFrame:
    """Per vector: vec_id, n_links, component_id and kept."""
    told = near_vectors(vectors.select("vec_id", "label", "embedding"))
    return told.select("row.vec_id", "n_links", "component_id", "kept")


ORACLE = f"""
with recursive v as (
  select vec_id, label, embedding::double[] as x, len(embedding) as dim from embeddings),
e as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.dim = b.dim and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.x, b.x) >= {LEAST_COSINE}),
r(node, reached) as (select vec_id, vec_id from v union select e.b, r.reached from r join e on e.a = r.node),
c as (select node, min(reached) as component_id from r group by node),
n as (select a, count(*) as n_links from e group by a)
select v.vec_id, coalesce(n_links, 0)::bigint as n_links, component_id, v.vec_id = component_id as kept
from v join c on c.node = v.vec_id left join n on n.a = v.vec_id
"""
