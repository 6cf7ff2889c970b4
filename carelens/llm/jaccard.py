"""Operator 7, n-gram Jaccard join with MinHash banding.

Documents with the same set of word shingles are one class. A class's signature is
cut into bands of several minhashes, one per tree. The length of the bands is fixed
before any data is read: the longest that finds pairs at the threshold with the
wanted probability. The classes that share a band form a bucket; buckets of the
same members in several trees are compared once. Comparison is exact, on whole
shingle sets, inside tasks and in blocks: no pair becomes a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.buckets import Arrays, dealt, grouped, in_group, roots
from carelens.llm.common import KEY, REPEATED, WORD, carrying, mapped, stored, text_of, with_keys
from carelens.llm.components import components

WORDS, SIMILARITY = 5, 0.8
#: Trees, minhashes in a label, and the least probability to meet a pair that is
#: just as similar as asked for; more similar ones are met more surely.
TREES, DEPTH, RECALL = 20, 6, 0.9999
#: Members compared with as many others in one group.
BLOCK = 128
#: Columns of the incidence matrix at once; shingles hashed at once; words kept.
COLUMNS, CHUNK, CACHED = 1 << 13, 1 << 15, 500_000


def shared_depth(trees: int = TREES, depth: int = DEPTH, similarity: float = SIMILARITY, recall: float = RECALL) -> int:
    """The length of the bands: the longest, up to ``depth``, whose recall at the
    threshold is enough. It depends on the parameters only, not on the data."""
    for d in range(depth, 1, -1):
        if 1 - (1 - similarity**d) ** trees >= recall:
            return d
    return 1


class WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHED:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


def shingles(text: str, known: WordHash, words: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the runs of ``words`` words, or of all
    words if there are fewer; none without a word."""
    found = text.encode("utf-8", "surrogatepass").split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    code = np.fromiter(map(known.__getitem__, found), dtype=np.uint64, count=len(found))
    width = min(words, len(code))
    n = len(code) - width + 1
    mix = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        mix = (mix ^ code[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        mix ^= mix >> np.uint64(31)
    return np.unique(mix)


def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240)
    return rng.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def signature(codes: np.ndarray, n: int) -> np.ndarray:
    """``n`` minhashes of a set, by multiply-add-shift functions."""
    a, b = _functions(n)
    out = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(codes), CHUNK):
        part = codes[start : start + CHUNK]
        for k in range(n):
            out[k] = min(out[k], (part * a[k] + b[k]).min())
    return out >> np.uint64(24)


def prefixes(codes: np.ndarray, depth: int, trees: int = TREES) -> np.ndarray:
    """For each tree the hash of the label's prefix, the tree in its upper bits, so
    that buckets of a lower tree are lower numbers."""
    labels = signature(codes, trees * depth).reshape(trees, depth)
    mix = np.zeros(trees, dtype=np.uint64)
    for k in range(depth):
        mix = (mix ^ labels[:, k]) * np.uint64(0xFF51AFD7ED558CCD)
        mix ^= mix >> np.uint64(32)
    return ((np.arange(trees, dtype=np.uint64) << np.uint64(57)) | (mix >> np.uint64(7))).view(np.int64)


def class_key(codes: np.ndarray) -> tuple[int, int]:
    digest = xxhash.xxh3_128_digest(codes.tobytes())
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def common_shingles(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two sets share, from the incidence of those that are
    in more than one, some columns at a time."""
    size = np.array([len(s) for s in sets])
    which = np.repeat(np.arange(len(sets)), size)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    which, column = which[shared], column[shared]
    order = np.argsort(column, kind="stable")
    which, column = which[order], column[order]
    out = np.zeros((len(sets), len(sets)))
    if not len(column):
        return out
    place = np.cumsum(np.concatenate([[0], column[1:] != column[:-1]]))
    for start in range(0, int(place[-1]) + 1, COLUMNS):
        low, high = np.searchsorted(place, [start, start + COLUMNS])
        part = np.zeros((len(sets), min(COLUMNS, int(place[high - 1]) - start + 1)), dtype=np.float32)
        part[which[low:high], place[low:high] - start] = 1
        out += part @ part.T
    return out


def compare(group: Arrays, similarity: float) -> list[tuple]:
    """(rep, links, root) of the rows of a group that link within it. A pair counts
    in the first tree where its prefixes agree, which is this bucket's or an earlier
    one's; copies count as often as there are."""
    _, first = np.unique(group["member"], return_index=True)  # rows that repeat an id come once
    if len(first) < 2:
        return []
    sets = [np.frombuffer(group["codes"][k], dtype=np.uint64) for k in first]
    own = np.stack([np.frombuffer(group["prefixes"][k], dtype=np.int64) for k in first])
    size = np.array([len(s) for s in sets], dtype=float)
    tree = int(group["bucket"][0]) >> 57
    ask = in_group(group["block"][first], group["_i"][0], group["_j"][0])
    ask &= np.minimum(size[:, None], size) >= similarity * np.maximum(size[:, None], size) - 1e-9
    for t in range(tree):
        ask &= own[:, t][:, None] != own[:, t]
    if not ask.any():
        return []
    used = np.flatnonzero(ask.any(axis=1))
    sets, size, ask, first = [sets[k] for k in used], size[used], ask[np.ix_(used, used)], first[used]
    both = common_shingles(sets)
    linked = ask & (both >= similarity * (size[:, None] + size - both) - 1e-9)
    at = np.flatnonzero(linked.any(axis=1))
    rep = group["rep"][first]
    n, root = linked @ group["copies"][first], roots(linked, rep)
    return list(zip(rep[at].tolist(), n[at].tolist(), root[at].tolist(), strict=True))


def near_documents(docs: DataFrame, similarity: float = SIMILARITY, words: int = WORDS) -> DataFrame:
    """doc_id, class_id, n_links, component_id and kept of every row of ``docs``.

    ``docs`` has doc_id and text. class_id is the least id with the same set of
    shingles; n_links is the number of other rows linked directly, copies included;
    component_id is the least id that links lead to, and kept tells whether it is
    the row's own. Texts without a word (null, empty, white space) and rows without
    an id link with nothing. Texts of fewer words than a shingle are one shingle.
    Rows that repeat an id and text are copies of each other."""
    depth = shared_depth(similarity=similarity)

    def make():
        known = WordHash()

        def run(found: list[str]):
            keys, sizes, packs = [], [], []
            for text in found:
                codes = shingles(text, known, words)
                keys.append(class_key(codes))
                sizes.append(len(codes))
                packs.append(prefixes(codes, depth).tobytes() if len(codes) else None)
            return [k[0] for k in keys], [k[1] for k in keys], sizes, packs

        return run

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", text_of("text").alias("text"))
    told = stored(
        mapped(carrying(docs, ["doc_id"], "text"), make, {"h1": "bigint", "h2": "bigint", "n": "bigint", "prefixes": "binary"})
        .select("row.doc_id", "h1", "h2", "n", "prefixes"), "signatures")
    fit = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    classes = stored(
        told.where(fit).groupBy("h1", "h2", "prefixes").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "classes")

    rows = stored(classes.select("h1", "prefixes").mapInPandas(unpack, "member bigint, bucket bigint"), "forest")
    sizes = rows.groupBy("bucket").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("member")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "member")).alias("y"))
    kept = sizes.where(F.col("n") > 1).groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket"))
    active = rows.join(kept.select("bucket", "n"), "bucket").groupBy("member").agg(
        F.collect_list(F.struct("bucket", "n")).alias("buckets"))  # one per tree at most
    wanted = stored(
        active.join(classes.select(F.col("h1").alias("member"), "rep", "copies"), "member"), "active")

    def again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHash()
        for batch in batches:
            made = []
            for k, text in enumerate(batch["text"]):
                codes = shingles(text, known, words)
                if class_key(codes)[0] == batch["member"].iat[k]:
                    made.append((k, codes.tobytes(), prefixes(codes, depth).tobytes()))
            out = batch.iloc[[m[0] for m in made]][["member", "rep", "copies", "buckets"]]
            yield out.assign(codes=[m[1] for m in made], prefixes=[m[2] for m in made])

    # the narrow side is hashed, so whole texts are moved once and never sorted
    sets = texts.join(wanted.hint("shuffle_hash"), texts["doc_id"] == wanted["rep"]).select(
        "member", "rep", "copies", "buckets", "text").mapInPandas(
        again, f"member bigint, rep {kind}, copies bigint, buckets array<struct<bucket:bigint,n:bigint>>, codes binary, prefixes binary")
    members = sets.withColumn("own", F.explode("buckets")).select(
        "own.bucket", "own.n", "member", "rep", "copies", "codes", "prefixes")
    groups = dealt(members, "member", BLOCK).withColumnRenamed("_block", "block")

    def join(group: Arrays) -> list[tuple]:
        return compare(group, similarity)

    found = stored(grouped(groups, ["bucket", "_i", "_j"], join, ["rep", "n", "root"], f"rep {kind}, n bigint, root {kind}"), "found")
    forest = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("rep").agg(F.sum("n").alias("n"))
    result = classes.join(links, "rep", "left").join(forest.withColumnRenamed("node", "rep"), "rep", "left").select(
        "h1", "h2", F.col("rep").alias("class_id"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"))
    own = told.select("doc_id", F.when(fit, F.col("h1")).alias("h1"), F.when(fit, F.col("h2")).alias("h2"))
    component = F.coalesce("component_id", "doc_id")
    return own.join(result, ["h1", "h2"], "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each class and tree."""
    for batch in batches:
        packed = b"".join(batch["prefixes"])
        yield pd.DataFrame({
            "member": np.repeat(batch["h1"].to_numpy(), TREES), "bucket": np.frombuffer(packed, dtype=np.int64)})


def without_near_copies(docs: DataFrame, similarity: float = SIMILARITY, words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` that stay: of each component one row, that with the least
    id; of rows that repeat an id and a text one. Different texts of one id are
    judged each by itself, and come after other ids. Texts without a word and rows
    without an id all stay."""
    marked = with_keys(docs)
    told = near_documents(marked.select(F.col(KEY).alias("doc_id"), "text"), similarity, words)
    gone = told.where(~F.col("kept")).select(F.col("doc_id").alias("__copy")).distinct()
    rest = marked.join(gone, F.col(KEY) == F.col("__copy"), "left_anti")
    twice = F.col(REPEATED) & text_of().rlike(WORD)
    once = rest.where(~twice).unionByName(rest.where(twice).dropDuplicates([KEY]))
    return once.select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE = rf"""
with recursive w as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
s as (
  select distinct doc_id, array_to_string(words[i:i+{WORDS - 1}], ' ') as shingle
  from (select *, unnest(range(1, greatest(len(words) - {WORDS - 1}, 1) + 1)) as i from w where len(words) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
k as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b using (shingle) where a.doc_id <> b.doc_id group by all),
e as (
  select k.a, k.b, k.k = x.n and k.k = y.n as same from k join n x on x.doc_id = k.a join n y on y.doc_id = k.b
  where 10 * k.k >= {round(10 * SIMILARITY)} * (x.n + y.n - k.k)),
r(node, reached) as (select doc_id, doc_id from documents union select e.b, r.reached from r join e on e.a = r.node),
c as (select node, min(reached) as component_id from r group by node),
l as (select a, count(*) as n_links, min(b) filter (where same) as twin from e group by a)
select d.doc_id, least(d.doc_id, coalesce(twin, d.doc_id)) as class_id, coalesce(n_links, 0)::bigint as n_links,
  component_id, d.doc_id = component_id as kept
from documents d join c on c.node = d.doc_id left join l on l.a = d.doc_id
"""
