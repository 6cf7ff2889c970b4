"""Operator 9, line dedup with a segment-partition edit join.

Equal lines are one class, found by hash with a map-side part. ``EDITS`` gives the
edits between two different lines by the length of the shorter one. Lines within so
many edits share one of as many segments and one more: the shorter line indexes its
segments, the longer one probes the few substrings that can be such a segment of a
line of each length. A line just above a border of lengths probes the class below
too. Segments and substrings meet as 64-bit keys; only the lines of keys that more
than one line has are read again and verified, with a banded bit-parallel edit
distance, inside tasks and in blocks. Every pair within the edits is found.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.buckets import Arrays, dealt, grouped, in_group, roots
from carelens.llm.common import KEY, stored, text_of, with_keys
from carelens.llm.components import components

Edits = tuple[tuple[int, int], ...]
#: From each length of the shorter line on, the edits that link; both rise. Shorter
#: lines than the first only match equal ones.
EDITS: Edits = ((20, 1), (40, 2), (250, 3))
#: Repeated lines from this length on are removed from documents: all of them.
REMOVED_CHARS = 0
BLOCK = 128
#: Names that no column of the documents has.
ID, GONE = "__lines_of", "__lines_gone"
#: Candidate lines that are broadcast to read their texts; more are joined.
BROADCAST_LINES = 500_000
#: Cells of one verification step.
CELLS = 1 << 21
#: Places up to this one are a line's own segments.
OWN = 63
#: Code points whose keys are made at once, which stay in the processor's cache, and lines
#: that a task remembers as done.
CHUNK, SEEN = 1 << 18, 1 << 18


def allowed(size: int, edits: Edits = EDITS) -> int:
    """The edits between a line of so many code points and one as long or longer."""
    return max((most for least, most in edits if size >= least), default=0)


def segment(size: int, i: int, edits: int) -> tuple[int, int]:
    """Start from 0 and length of segment ``i``; the last ones are the longer ones."""
    parts = edits + 1
    short, longer = divmod(size, parts)
    before = max(0, i - (parts - longer))
    return i * short + before, short + (i >= parts - longer)


@cache
def probes(edits: int) -> list[tuple[int, int, int]]:
    """(length difference, segment, shift) of the substrings that a line compares
    with segments of lines that are as long or shorter by the difference. Edits
    before the segment and after it bound the shift from either side."""
    found = []
    for less in range(edits + 1):
        for i in range(edits + 1):
            low, high = max(-i, less - (edits - i)), min(i, less + (edits - i))
            found += [(less, i, shift) for shift in range(low, high + 1)]
    return found


def _mixed(codes: np.ndarray) -> np.ndarray:
    """64-bit values of which all bits depend on all bits."""
    codes = (codes + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    codes ^= codes >> np.uint64(32)
    codes *= np.uint64(0xD6E8FEB86659FD93)
    return codes ^ (codes >> np.uint64(32))


def powers_up_to(most: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers from 0 of the hash's base, and of its inverse."""
    base = 0x5851F42D4C957F2D
    powers, inverse = (np.full(most + 1, b, dtype=np.uint64) for b in (base, pow(base, -1, 1 << 64)))
    powers[0] = inverse[0] = 1
    return np.cumprod(powers, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64)


@cache
def kept_powers(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Those that most chunks need."""
    return powers_up_to(most)


def line_keys(lines: list[str], edits: Edits = EDITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, key, place) of each segment and each probed substring of lines. Segments
    have their number as place, other substrings one above ``OWN``.

    A key is the length of the indexed line, the segment and a hash of the substring:
    the difference of two sums of characters times powers, over the power of its start."""
    size = np.array([len(x) for x in lines], dtype=np.int64)
    start = np.cumsum(size) - size
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    found_powers = kept_powers(CHUNK) if len(codes) <= CHUNK else powers_up_to(len(codes))
    powers, inverse = (x[: len(codes) + 1] for x in found_powers)
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(_mixed(codes.astype(np.uint64)) * powers[:-1], dtype=np.uint64, out=sums[1:])
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for k, (least, most) in enumerate(edits):
        under = edits[k + 1][0] if k + 1 < len(edits) else np.iinfo(np.int64).max
        for less, i, shift in probes(most):
            target = size - less
            line = np.flatnonzero((target >= least) & (target < under))
            short, longer = np.divmod(target[line], most + 1)
            first = i * short + np.maximum(0, i - (most + 1 - longer)) + shift
            width = short + (i >= most + 1 - longer)
            inside = (first >= 0) & (first + width <= size[line])
            line, first, width = line[inside], first[inside], width[inside]
            at = start[line] + first
            piece = (sums[at + width] - sums[at]) * inverse[at]
            key = _mixed(piece ^ _mixed((target[line] * 64 + i).astype(np.uint64)))
            place = i if less == shift == 0 else OWN + 1
            found.append((line, key.view(np.int64), np.full(len(line), place, dtype=np.int32)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def keyed(edits: Edits):
    """A task that makes a row (bucket, place, member) for each key of lines (member,
    line). It remembers the last lines it has seen, so that copies of a very frequent
    one send few rows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            members, once = np.unique(batch.column(0).to_numpy(), return_index=True)
            new = np.array([m not in seen for m in members.tolist()], dtype=bool)
            members, once = members[new], once[new]
            if len(seen) > SEEN:
                seen = set()
            seen.update(members.tolist())
            texts = batch.column(1).take(pa.array(once)).to_pylist()
            start = 0
            while start < len(texts):  # as many lines as fit
                end, chars = start, 0
                while end < len(texts) and (end == start or chars + len(texts[end]) <= CHUNK):
                    chars += len(texts[end])
                    end += 1
                line, key, place = line_keys(texts[start:end], edits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(place), pa.array(members[start:end][line])], ["bucket", "place", "member"])
                start = end

    return task


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line) of every line with a word."""
    rows = docs.select("doc_id", F.posexplode(F.split(text_of("text"), "\n", -1)).alias("line_no", "line"))
    return rows.where(F.btrim("line", F.lit(" \t\n\x0b\x0c\r")) != "")


def edit_distances(a: list[np.ndarray], b: list[np.ndarray], most: int) -> np.ndarray:
    """The edit distance of each pair of code-point arrays, or ``most`` + 1 beyond.

    For each number of errors a word of bits tells which diagonals of the band are
    reachable after a character of ``b``; all pairs take a step together."""
    pairs = len(a)
    out = np.full(pairs, most + 1)
    la, lb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    fits = np.flatnonzero(np.abs(la - lb) <= most)
    order = fits[np.argsort(lb[fits], kind="stable")]
    start = 0
    while start < len(order):
        # as many pairs of rising length as fit
        sizes = lb[order[start:]] + 2 * most + 1
        n = max(1, int(np.searchsorted(np.arange(1, len(sizes) + 1) * sizes, CELLS, side="right")))
        at = order[start : start + n]
        start += n
        width = int(lb[at].max())
        left = np.full((width + 4 * most + 1, len(at)), 0xFFFFFFFE, dtype=np.uint32)
        right = np.full((width + 1, len(at)), 0xFFFFFFFF, dtype=np.uint32)
        for k, p in enumerate(at):
            left[most : most + la[p], k] = a[p]
            right[: lb[p], k] = b[p]
        band = np.uint32((1 << (2 * most + 1)) - 1)
        alive = np.arange(len(at))
        reach = [np.full(len(at), sum(1 << (most + d) for d in range(e + 1)), dtype=np.uint32) for e in range(most + 1)]
        ends, goal = lb[at], np.uint32(1) << (la[at] - lb[at] + most).astype(np.uint32)
        for i in range(width + 1):
            done = ends[alive] == i
            if done.any():
                for e in range(most, -1, -1):
                    hit = done & ((reach[e] & goal[alive]) != 0)
                    out[at[alive[hit]]] = e
            if i == width:
                break
            if done.any() or i % 16 == 15 or i in (3, 7):  # most pairs end early
                stay = ~done & (reach[most] != 0)
                alive, reach = alive[stay], [r[stay] for r in reach]
                if not len(alive):
                    break
            whole = len(alive) == len(at)
            text = right[i] if whole else right[i, alive]
            match = np.zeros(len(alive), dtype=np.uint32)
            for d in range(2 * most + 1):
                row = left[i + d] if whole else left[i + d, alive]
                match |= (row == text).astype(np.uint32) << np.uint32(d)
            new = [reach[0] & match]
            for e in range(1, most + 1):
                step = (reach[e] & match) | reach[e - 1] | (reach[e - 1] >> np.uint32(1)) | (new[e - 1] << np.uint32(1))
                new.append(step & band)
            reach = new
    return out


def _trimmed(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both without what they share at their ends."""
    n = min(len(a), len(b))
    differ = a[:n] != b[:n]
    head = int(differ.argmax()) if differ.any() else n
    a, b, n = a[head:], b[head:], n - head
    differ = a[len(a) - n :][::-1] != b[len(b) - n :][::-1]
    tail = int(differ.argmax()) if n and differ.any() else n
    return a[: len(a) - tail], b[: len(b) - tail]


class Compare:
    """Makes (member, links, root) of the lines that link within a group. Groups are
    many and small, so the pairs of some are held and verified together.

    A pair is an indexed line and a longer one, or one as long with a greater id.
    It counts at the first segment that the longer line's probes find."""

    def __init__(self, edits: Edits) -> None:
        self.edits = edits
        self.held: list[tuple] = []
        self.pairs = self.chars = 0

    def __call__(self, group: Arrays) -> list[tuple]:
        member, first = np.unique(group["member"], return_index=True)
        own = np.isin(member, group["member"][group["own"]])
        if len(member) < 2 or not own.any():
            return []
        pieces = [group["line"][k] for k in first]
        size = np.array([len(t) for t in pieces])
        here = in_group(group["block"][first], group["_i"][0], group["_j"][0])
        for n in np.unique(size[own]).tolist():  # one, but for equal keys of unlike lines
            most = allowed(n, self.edits)
            ask = here & (own & (size == n))[:, None] & (size >= n) & (size <= n + most)
            ask &= (size > n) | (member > member[:, None])
            left, right = _first_at(ask, pieces, size, n, int(group["place"][0]), most)
            if len(left):
                text = {k: np.frombuffer(pieces[k].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
                        for k in {*left.tolist(), *right.tolist()}}
                cut = [_trimmed(text[r], text[s]) for r, s in zip(left.tolist(), right.tolist(), strict=True)]
                self.held.append((member, group["copies"][first], left, right, most, cut))
                self.pairs += len(cut)
                self.chars += sum(map(len, text.values()))
        return self.rest() if self.pairs > 4000 or self.chars > CELLS else []

    def rest(self) -> list[tuple]:
        held, found = self.held, []
        self.__init__(self.edits)
        for most in {h[4] for h in held}:
            some = [h for h in held if h[4] == most]
            cut = [c for h in some for c in h[5]]
            near = edit_distances([c[0] for c in cut], [c[1] for c in cut], most) <= most
            ends = np.cumsum([len(h[5]) for h in some])
            for (member, copies, left, right, _, _), ok in zip(some, np.split(near, ends[:-1]), strict=True):
                if not ok.any():
                    continue
                linked = np.zeros((len(member), len(member)), dtype=bool)
                linked[left[ok], right[ok]] = True
                linked |= linked.T
                at = np.flatnonzero(linked.any(axis=1))
                n, root = linked @ copies, roots(linked, member)
                found += zip(member[at].tolist(), n[at].tolist(), root[at].tolist(), strict=True)
        return found


def _first_at(ask: np.ndarray, pieces: list[str], size: np.ndarray, n: int, index: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the asked pairs of an indexed line of ``n`` code points and another, those
    that share segment ``index`` and none before it."""
    if index > most:
        return np.zeros(0, dtype=int), np.zeros(0, dtype=int)
    for i in range(index + 1):
        if not ask.any():
            break
        start, width = segment(n, i, most)
        codes: dict[str, int] = {}
        mine = np.full(len(size), -2)
        for k in np.flatnonzero(ask.any(axis=1)).tolist():
            mine[k] = codes.setdefault(pieces[k][start : start + width], len(codes))
        found = np.zeros_like(ask)
        asked = ask.any(axis=0)
        for less, j, shift in probes(most):
            if j == i and start + shift >= 0:
                theirs = np.full(len(size), -1)
                for k in np.flatnonzero(asked & (size == n + less)).tolist():
                    theirs[k] = codes.get(pieces[k][start + shift : start + shift + width], -1)
                found |= mine[:, None] == theirs
        ask = ask & (found if i == index else ~found)
    return np.nonzero(ask)


def shared_keys(own: int):
    """A task that keeps rows (bucket, place, member), sorted by bucket and place, of
    buckets that some line indexes (a place up to ``own``) and more than one line has: each member with its
    least place, maybe more than once. It holds a batch and the first row of the
    last bucket, whatever a bucket's size."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, going = None, False  # the last bucket's first row; whether its rows are kept
        for batch in batches:
            if pending is not None:
                batch = pa.concat_batches([pending, batch]) if not going else batch
            if not batch.num_rows:
                continue
            bucket, place, member = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(bucket))))
            kept = (place[starts] <= own) & np.logical_or.reduceat(member != member[starts][run], starts)
            if going and pending.column(0)[0].as_py() == bucket[0]:
                kept[0] = True
            yield batch.filter(pa.array(kept[run]))
            pending, going = batch.slice(int(starts[-1]), 1), bool(kept[-1])

    return task


def indexed(lines: DataFrame, edits: Edits) -> DataFrame:
    """(bucket, place, member) of all keys of lines (member, line), each bucket in one
    task, sorted by bucket and place. The place takes the last bits of the key (three for
    ``EDITS``), so that narrow rows are sorted by one number."""
    other = edits[-1][1] + 1  # above all segments' numbers
    bits = F.lit((1 << other.bit_length()) - 1).cast("long")
    made = lines.mapInArrow(keyed(edits), "bucket bigint, place int, member bigint")
    place = F.least("place", F.lit(other)).cast("long")
    rows = made.select(F.col("bucket").bitwiseAND(F.bitwise_not(bits)).bitwiseOR(place).alias("key"), "member")
    bucket, place = F.col("key").bitwiseAND(F.bitwise_not(bits)), F.col("key").bitwiseAND(bits).cast("int")
    return rows.repartition(bucket).sortWithinPartitions("key").select(
        bucket.alias("bucket"), F.when(place < other, place).otherwise(OWN + 1).alias("place"), "member")


def _texts(lines: DataFrame, rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(member, line, copies) of the members of ``rows``, read from ``lines``."""
    ids = stored(rows.select("member").distinct(), "members")
    few = ids.count() <= BROADCAST_LINES
    wanted_ids = F.broadcast(ids) if few else ids.hint("shuffle_hash")
    texts = lines.join(wanted_ids, "member", "left_semi").dropDuplicates(["member"])
    copies = classes.groupBy(F.col("h1").alias("member")).agg(F.sum("copies").alias("copies"))
    return texts.join(copies, "member")


def near_lines(docs: DataFrame, edits: Edits = EDITS) -> DataFrame:
    """doc_id, line_no, n_chars, n_links, class_doc, class_line and kept of every line
    with a word.

    ``docs`` has doc_id and text; lines end at \\n. n_links is the number of other
    lines of all documents within the edits that ``edits`` allows by the length of the
    shorter one, equal ones included; class_doc and class_line are the place of the
    first line, by id and number, that such links lead to, and kept tells whether it
    is the line's own. Lines shorter than any length of ``edits`` link with equal ones
    only. Null and empty texts have no lines; a null id comes first. Rows that repeat
    an id are one document: a line that both have is at one place and both stay."""
    lines = lines_of(docs)
    hashed = lines.select(
        "doc_id", "line_no", "line", F.length("line").alias("n_chars"), F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))
    classes = stored(
        hashed.groupBy("h1", "h2", "n_chars").agg(F.min(F.struct("doc_id", "line_no")).alias("first"), F.count("*").alias("copies")),
        "lines")
    long = hashed.where(F.col("n_chars") >= edits[0][0]).select(F.col("h1").alias("member"), "line")
    rows = stored(
        indexed(long, edits).mapInArrow(shared_keys(OWN), "bucket bigint, place int, member bigint")
        .groupBy("bucket", "member").agg(F.min("place").alias("place")), "shared")
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min("place").alias("segment"))
    members = rows.join(sizes, "bucket").join(_texts(long, rows, classes), "member").select(
        "bucket", "n", "member", (F.col("place") <= OWN).alias("own"), F.col("segment").alias("place"), "copies", "line")
    groups = dealt(members, "member", BLOCK).withColumnRenamed("_block", "block")
    found = stored(grouped(groups, ["bucket", "_i", "_j"], Compare(edits), ["member", "n", "root"], "member bigint, n bigint, root bigint"), "found")
    forest = components(found.select(F.col("member").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "h1")
    links = found.groupBy(F.col("member").alias("h1")).agg(F.sum("n").alias("n"))
    plain = classes.select("h1", "h2", "first", "copies")
    linked = plain.join(forest, "h1").groupBy("component").agg(F.min("first").alias("earliest"))
    # by line, not by component: most lines have none, and their nulls would meet in one task
    placed = forest.join(linked, "component").select("h1", "earliest")
    told = plain.join(links, "h1", "left").join(placed, "h1", "left").select(
        "h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("earliest", "first").alias("earliest"))
    return hashed.select("doc_id", "line_no", "n_chars", "h1", "h2").join(told, ["h1", "h2"]).select(
        "doc_id", "line_no", "n_chars", "n_links", F.col("earliest.doc_id").alias("class_doc"),
        F.col("earliest.line_no").alias("class_line"),
        (F.col("doc_id").eqNullSafe(F.col("earliest.doc_id")) & (F.col("line_no") == F.col("earliest.line_no"))).alias("kept"))


def without_repeated_lines(docs: DataFrame, removed_chars: int = REMOVED_CHARS, edits: Edits = EDITS) -> DataFrame:
    """``docs`` without the lines that an earlier line stands for, whatever their
    length; a caller may spare those under ``removed_chars`` code points. Rows without
    an id stay as they are. A document goes if none of its lines with a word is left;
    one that had none to begin with stays as it is. Column names and other columns
    stay. Rows that repeat an id and a text keep the same lines; different texts of one
    id are documents of their own, after those with other ids."""
    marked = with_keys(docs)
    told = near_lines(marked.select(F.col(KEY).alias("doc_id"), "text"), edits)
    repeated = told.where(~F.col("kept") & (F.col("n_chars") >= removed_chars) & F.col("doc_id").isNotNull())
    gone = repeated.groupBy(F.col("doc_id").alias(ID)).agg(
        F.collect_set("line_no").alias(GONE))  # at most one document's lines
    split = F.split(F.col("text"), "\n", -1)
    places = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(GONE))
    text = F.array_join(F.transform(places, lambda i: F.get(split, i)), "\n")
    changed = F.col(GONE).isNotNull()
    rest = marked.join(gone.hint("shuffle_hash"), F.col(KEY) == F.col(ID), "left")
    rest = rest.withColumn("text", F.when(changed, text).otherwise(F.col("text")))
    return rest.where(~changed | (F.btrim("text", F.lit(" \t\n\x0b\x0c\r")) != "")).select(*[F.col(f"`{c}`") for c in docs.columns])
