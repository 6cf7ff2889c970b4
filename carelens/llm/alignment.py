"""Operator 12, alignment of two tokenizers' tokens over the bytes of each text.

A text's tokens of either kind cut its bytes. Every token points to the farthest-right
token of the other kind that it overlaps, and successor doubling over whole arrays
brings each to the terminal token of its component, which labels its group: groups end
where tokens of both kinds end. Overlapping pairs are told from the joined list of ends.

Neither tokenizer joins anything across a space that follows a sign other than white space,
so a text is a sequence of chunks between such spaces: each distinct chunk is
encoded and aligned once. Texts are worked off in parts of bounded size; a part is one
stored row that holds its chunks' pairs once and, for each document, the numbers of its
chunks. Corpus-wide counts are added up per task and then per pair, and
a second pass over the stored parts takes each document's sums.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from carelens.llm.bpe import Seen
from carelens.llm.common import give_back, stored, text_of

#: Bytes of the texts of a part; a longer text is a part.
TEXT_BYTES = 1_500_000
#: Chunks kept in each of the two generations of a worker's cache, and the longest kept.
#: Most stand in one part only; they are kept from the second on.
CACHED, CACHED_CHARS = 100_000, 64
#: Chunks that are learnt at once.
LEARNT = 5_000
#: Distinct pairs (17 bytes each) up to which their counts are broadcast; beyond, each
#: part's pairs are joined to them.
BROADCAST_PAIRS = 2_000_000
#: Pairs that a task holds before it passes their counts on.
HELD_PAIRS = 1_000_000
#: Letters, and the ASCII signs after them but for the apostrophe: the first tokenizer
#: cuts between the two and nowhere else.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
WORD = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: White space of any kind, for both tokenizers and for Python, before a space.
DOUBLE = r"(^|[\s\x0b\x1c-\x1f\x{85}\p{Z}]) "
CHUNK = re.compile(r"(?<=\S)(?= )")
#: How a byte-level vocabulary writes bytes: those with a sign of their own, then the
#: others as the letters from 256 on.
OWN_SIGN = [*range(33, 127), *range(161, 173), *range(174, 256)]
SIGNS = {b: chr(b) for b in OWN_SIGN} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(OWN_SIGN)))}
BYTE_OF = {s: b for b, s in SIGNS.items()}

PART = (
    "doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, "
    "groups_sha256 array<string>, chunks binary, ends binary, pairs binary, pair_ends binary")
TOLD = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def packed_array(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def array_of(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=kind)


def labels(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For ascending ends of tokens of both kinds over the same bytes: the tokens of
    the second kind that end a group, and each token's group, by pointer jumping.

    A token of the first kind points to that of the second kind which holds its last
    byte; one of the second kind does the same the other way round, or to itself if
    a token of the first kind ends where it does. Pointers never go left."""
    n = len(a_end)
    to_b = np.searchsorted(b_end, a_end)
    to_a = np.searchsorted(a_end, b_end)
    own = np.arange(len(b_end)) + n
    next_one = np.concatenate([to_b + n, np.where(a_end[to_a] == b_end, own, to_a)]) if n else own
    while True:
        further = next_one[next_one]
        if (further == next_one).all():
            break
        next_one = further
    terminal = np.flatnonzero(next_one[n:] == own)
    group = np.searchsorted(terminal, next_one - n)
    return terminal, group[:n], group[n:]


class Aligner:
    """Both tokenizers, and what they make of chunks, kept in two generations."""

    def __init__(self, a_json: str, b_model: bytes):
        self.a = Tokenizer.from_str(a_json)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.a_model = self.a.model
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        vocabulary = self.a.get_vocab()
        special = {t["content"] for t in json.loads(a_json).get("added_tokens", [])}
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            plain = token not in special and all(s in BYTE_OF for s in token)
            self.a_bytes[i] = bytes(BYTE_OF[s] for s in token) if plain else token.encode()
        self.b_bytes = [self._b_bytes(i) for i in range(self.b.get_piece_size())]
        self.a_len = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        self.names = [str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        # the second tokenizer puts a space before a text; chunks have theirs, so they follow a word
        self.before = self.b.encode("a")
        # of the second, no piece may hold a letter and a sign after it
        crossing = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ][!-&(-/:-@\[-`{-~]")
        self.plain = self._ask_a(" Word,") == self._model_a(" Word") + self._model_a(",") and not any(
            crossing.search(self.b.id_to_piece(i)) for i in range(3, self.b.get_piece_size()) if not self.b.is_byte(i))
        self.new: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}
        self.signs: dict[str, tuple] = {}
        self.seen = Seen()

    def _b_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def _ask_a(self, chunk: str) -> list[int]:
        return self.a.encode(chunk, add_special_tokens=False).ids

    def _model_a(self, word: str) -> list[int]:
        return [t.id for t in self.a_model.tokenize("".join([SIGNS[b] for b in word.encode()]))]

    def encode_a(self, piece: str, space: bool) -> list[int]:
        """The first tokenizer's ids of a space and a piece, or of signs after letters."""
        if not space:
            return self._model_a(piece)
        return self._model_a(" " + piece) if self.plain and WORD.fullmatch(piece) else self._ask_a(" " + piece)

    def _learn(self, pieces: list[str], space: bool) -> dict[str, tuple]:
        """For each piece: its groups as text, the numbers of tokens and groups, and
        the linked pairs, as bytes of longs; empty if the tokens' bytes are not the
        chunk's. A chunk is a ``space`` and the piece, or else signs after letters,
        which no token of either kind holds together with them."""
        if not pieces:
            return {}
        a_ids = [self.encode_a(p, space) for p in pieces]
        found = self.b.encode([f"a {p}" if space else f"a{p}" for p in pieces], num_threads=1)
        k = len(self.before)
        b_ids = [ids[k:] if ids[:k] == self.before else [] for ids in found]
        raw = [(" " + p if space else p).encode() for p in pieces]
        out: dict[str, tuple] = {}
        size = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        flat, ends = [], []
        for kind, length, of in ((a_ids, self.a_len, self.a_bytes), (b_ids, self.b_len, self.b_bytes)):
            whole = list(chain.from_iterable(kind))
            flat.append(np.array(whole, dtype=np.int64))
            ends.append(np.cumsum(length[flat[-1]]))
            cut = np.cumsum(np.fromiter(map(len, kind), dtype=np.int64, count=len(kind)))
            same = b"".join(map(of.__getitem__, whole)) == b"".join(raw)
            if not same or not np.array_equal(np.concatenate([[0], ends[-1]])[cut], np.cumsum(size)):
                break
        else:
            return self._told(pieces, a_ids, b_ids, size, flat, ends)
        fine = [
            b"".join([self.a_bytes[i] for i in a]) == r == b"".join([self.b_bytes[i] for i in b])
            for a, b, r in zip(a_ids, b_ids, raw, strict=True)]
        out = {p: () for p, f in zip(pieces, fine, strict=True) if not f}
        kept = [x for x in zip(pieces, a_ids, b_ids, size.tolist(), fine, strict=True) if x[-1]]
        if kept:
            pieces, a_ids, b_ids, sizes, _ = zip(*kept, strict=True)
            flat = [np.array(list(chain.from_iterable(kind)), dtype=np.int64) for kind in (a_ids, b_ids)]
            ends = [np.cumsum(length[x]) for length, x in zip((self.a_len, self.b_len), flat, strict=True)]
            out |= self._told(pieces, a_ids, b_ids, np.array(sizes), flat, ends)
        return out

    def _told(self, pieces, a_ids, b_ids, size: np.ndarray, flat: list[np.ndarray], both: list[np.ndarray]) -> dict[str, tuple]:
        a_end, b_end = both
        terminal, a_group, b_group = labels(a_end, b_end)
        chunk_end = np.cumsum(size)
        ends = np.union1d(a_end, b_end)
        pairs = flat[0][np.searchsorted(a_end, ends)] << 32 | flat[1][np.searchsorted(b_end, ends)]
        pair_end = (np.searchsorted(ends, chunk_end, side="right") * 8).tolist()
        group_end = np.searchsorted(b_end[terminal], chunk_end, side="right").tolist()
        every = np.arange(len(terminal))
        a_cut = np.searchsorted(a_group, every, side="right").tolist()
        b_cut = np.searchsorted(b_group, every, side="right").tolist()
        a_name, b_name = (list(map(self.names.__getitem__, ids.tolist())) for ids in flat)
        texts, x, y = [], 0, 0
        for i, j in zip(a_cut, b_cut, strict=True):
            left = a_name[x] if i - x == 1 else ",".join(a_name[x:i])
            texts.append(f"{left}|{b_name[y] if j - y == 1 else ','.join(b_name[y:j])}")
            x, y = i, j
        out, data = {}, pairs.tobytes()
        p0 = g0 = 0
        for piece, a, b, p1, g1 in zip(pieces, a_ids, b_ids, pair_end, group_end, strict=True):
            out[piece] = (texts[g0] if g1 - g0 == 1 else ";".join(texts[g0:g1]), len(a), len(b), g1 - g0, data[p0:p1])
            p0, g0 = p1, g1
        return out

    def chunks(self, pieces: list[str]) -> list[tuple]:
        """What is known of each piece, and what is not yet: of letters and signs the
        two parts are learnt."""
        if len(self.new) > CACHED:
            self.old, self.new = self.new, {}
        if len(self.signs) > CACHED:
            self.signs = {}
        told = list(map(self.new.get, pieces))
        cut, words, signs = [], {}, {}
        for i, (p, t) in enumerate(zip(pieces, told, strict=True)):
            if t is None:
                m = PLAIN.fullmatch(p) if self.plain else None
                a, b = m.groups() if m else (p, "")
                words[a] = self.old.get(a) if b == "" else self.new.get(a) or self.old.get(a)
                if b and b not in self.signs:
                    signs[b] = None
                cut.append((i, a, b))
        missing = [w for w, t in words.items() if t is None]
        for start in range(0, len(missing), LEARNT):
            words |= self._learn(missing[start : start + LEARNT], True)
        ends = self.signs | self._learn(list(signs), False) if signs else self.signs
        for i, a, b in cut:
            x = words[a]
            if b:
                y = ends[b]
                x = (f"{x[0]};{y[0]}", x[1] + y[1], x[2] + y[2], x[3] + y[3], x[4] + y[4]) if x and y else ()
            told[i] = x
        once = set(self.seen.new(missing))
        self.new |= {w: v for w, v in words.items() if w not in once and len(w) <= CACHED_CHARS}
        self.signs |= {b: ends[b] for b in signs if len(b) <= CACHED_CHARS}
        return told

    def part(self, doc_ids: list, pieces: pa.Array, offsets: np.ndarray, fit: np.ndarray, wanted: bool = False) -> dict:
        """One stored row: the documents of a part, whose pieces lie between the
        offsets. Documents that are not ``fit``, or one of whose chunks fails, have no
        tokens. ``wanted`` asks for the groups' texts instead of their hashes."""
        found = pieces.dictionary_encode()
        told = self.chunks(found.dictionary.to_numpy(zero_copy_only=False).tolist())
        code = found.indices.to_numpy().astype(np.int64)
        size = np.diff(offsets)
        failed = np.array([not t for t in told], dtype=bool)
        if failed.any():
            bad = np.concatenate([[0], np.cumsum(failed[code])])
            fit = fit & (bad[offsets[1:]] == bad[offsets[:-1]])
        keep = np.repeat(fit, size)
        told = [t or ("", 0, 0, 0, b"") for t in told]
        names, *numbers, pairs = zip(*told, strict=True) if told else ((), (), (), (), ())
        numbers.append(np.fromiter(map(len, pairs), dtype=np.int64, count=len(pairs)) // 8)
        per_doc = []
        for value in numbers:
            sums = np.concatenate([[0], np.cumsum(np.asarray(value, dtype=np.int64)[code])])
            per_doc.append(np.diff(sums[offsets]) * fit)
        pair_size, texts = numbers[-1], list(map(names.__getitem__, code.tolist()))
        at, text = offsets.tolist(), []
        for a, b, f in zip(at, at[1:], fit.tolist(), strict=False):
            whole = ";".join(texts[a:b]) if f else ""
            text.append(whole if wanted or not f else hashlib.sha256(whole.encode()).hexdigest())
        row = dict(zip(("n_a", "n_b", "n_groups", "n_links"), [x.tolist() for x in per_doc], strict=True))
        row |= {"doc_id": doc_ids, "groups_sha256": text}
        if not wanted:
            row |= {
                "chunks": packed_array(code[keep].astype(np.int32)), "ends": packed_array(np.cumsum(size * fit)),
                "pairs": packed_array(np.frombuffer(b"".join(pairs), dtype=np.int64)),
                "pair_ends": packed_array(np.cumsum(pair_size))}
        return row

    def parts(self, doc_ids: pa.Array, texts: pa.Array, wanted: bool = False) -> Iterator[dict]:
        """The rows of some documents. Most texts have no space after white space and
        are cut by Arrow; the others, which come last in their part, by a pattern."""
        for at, upto in spans(texts):
            ids, some = doc_ids.slice(at, upto - at), texts.slice(at, upto - at)
            odd = pc.match_substring_regex(some, DOUBLE)
            by_kind = [odd] if pc.all(odd).as_py() else [pc.invert(odd), odd] if pc.any(odd).as_py() else [pc.invert(odd)]
            pieces, offsets = [], [np.zeros(1, dtype=np.int64)]
            for here in by_kind:
                part = some.filter(here)
                if here is odd:
                    cut = [[c[1:] for c in CHUNK.split(" " + t)] for t in part.to_pylist()]
                    size = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
                    pieces.append(pa.array(chain.from_iterable(cut), pa.string()))
                else:
                    cut = pc.split_pattern(part, " ")
                    size = np.diff(cut.offsets.to_numpy().astype(np.int64))
                    pieces.append(cut.flatten())
                offsets.append(offsets[-1][-1] + np.cumsum(size))
            ids, some = (pa.concat_arrays([x.filter(here) for here in by_kind]) for x in (ids, some))
            fit = np.not_equal(pc.binary_length(some).to_numpy(zero_copy_only=False), 0)
            yield self.part(ids.to_pylist(), pa.concat_arrays(pieces), np.concatenate(offsets), fit, wanted)


def one_by_one(batch: pa.RecordBatch) -> Iterator[dict]:
    """Its rows, of which one at a time is copied."""
    for i in range(batch.num_rows):
        yield from batch.slice(i, 1).to_pylist()


def spans(texts: pa.Array) -> Iterator[tuple[int, int]]:
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        base = int(ends[at - 1]) if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, base + TEXT_BYTES, side="right")))
        yield at, upto
        at = upto


def aligner_of(shared: dict) -> Aligner:
    """The aligner of broadcast vocabularies, made once in each Python worker. It keeps
    many tuples and makes no cycles, so the worker looks for cycles less often."""
    if "aligner" not in shared:
        gc.set_threshold(200_000, 50, 100)
        shared["aligner"] = Aligner(shared["a"], shared["b"])
    return shared["aligner"]


def _rows(docs: DataFrame, a_path: str, b_path: str, wanted: bool) -> DataFrame:
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:
        shared = docs.sparkSession.sparkContext.broadcast({"a": f.read(), "b": g.read()})
    schema = "doc_id array<bigint>, groups_sha256 array<string>" if wanted else PART
    names = [c.strip().split(" ")[0] for c in schema.split(", ")]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        aligner = aligner_of(shared.value)
        kinds = [pa.list_(pa.string()) if n == "groups_sha256" else pa.list_(pa.int64()) if n not in ("chunks", "ends", "pairs", "pair_ends")
                 else pa.binary() for n in names]
        for batch in batches:
            for row in aligner.parts(batch.column(0), batch.column(1), wanted):
                yield pa.RecordBatch.from_arrays([pa.array([row[n]], k) for n, k in zip(names, kinds, strict=True)], names)
                del row
                give_back()  # what the part took, which the worker would hold beside its executor

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text")).mapInArrow(task, schema)


def aligned_groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id and groups (``a1,a2|b1;a3|b2,b3``: decimal ids, in order; empty without
    tokens) of every document."""
    rows = _rows(docs, a_path, b_path, True).select(F.explode(F.arrays_zip("doc_id", "groups_sha256")).alias("row"))
    return rows.select("row.doc_id", F.col("row.groups_sha256").alias("groups"))


def stored_parts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The parts of ``docs`` (doc_id, text) with a number each, written once: both
    passes over them see the same rows."""
    return stored(_rows(docs, a_path, b_path, False).withColumn("part", F.monotonically_increasing_id()), "parts")


def pair_counts(parts: DataFrame) -> DataFrame:
    """pair (first id << 32 | second id), n (links of the corpus that hold the pair) and
    best (whether no pair of its second id has more), stored."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            sums = np.zeros(len(keys), dtype=np.int64)
            np.add.at(sums, at, np.concatenate([n for _, n in held]))
            return keys, sums

        def batch_of(keys: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], ["pair", "n"])

        for batch in batches:
            for row in one_by_one(batch):
                ends = array_of(row["pair_ends"], "<i8")
                times = np.bincount(array_of(row["chunks"], "<i4"), minlength=len(ends))
                times = np.repeat(times, np.diff(ends, prepend=0))
                pairs, used = array_of(row["pairs"], "<i8"), times > 0
                held.append((pairs[used], times[used]))
                if sum(len(k) for k, _ in held) > HELD_PAIRS:
                    held = [merged()]
                    if len(held[0][0]) > HELD_PAIRS // 2:
                        yield batch_of(*held.pop())
        if held:
            yield batch_of(*merged())

    counts = parts.select("chunks", "pairs", "pair_ends").mapInArrow(task, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = stored(counts.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))), "pair-counts")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def told(row: dict, keys: np.ndarray, n: np.ndarray, best: np.ndarray) -> pd.DataFrame:
    """The documents of a part with their sums; ``keys`` are ascending pairs with their
    counts, at least those of the part."""
    pairs, ends = array_of(row["pairs"], "<i8"), array_of(row["pair_ends"], "<i8")
    code, doc_end = array_of(row["chunks"], "<i4"), array_of(row["ends"], "<i8")
    distinct, at = np.unique(pairs, return_inverse=True)
    place = np.minimum(np.searchsorted(keys, distinct), max(len(keys) - 1, 0))
    known = keys[place] == distinct if len(keys) else np.zeros(len(distinct), dtype=bool)
    # chunks of failed documents alone have pairs that the corpus doesn't count

    def per_doc(value: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(value[at])])
        per_chunk = np.diff(sums[np.concatenate([[0], ends])])
        sums = np.concatenate([[0], np.cumsum(per_chunk[code])])
        return np.diff(sums[np.concatenate([[0], doc_end])])

    def values(column: np.ndarray) -> np.ndarray:
        return np.where(known, column[place], 0) if len(keys) else np.zeros(len(distinct), dtype=np.int64)

    return pd.DataFrame({
        "doc_id": pd.array(row["doc_id"], dtype="Int64"), **{c: row[c] for c in ("n_a", "n_b", "n_groups", "n_links")},
        "n_best": per_doc(values(best.astype(np.int64))), "count_sum": per_doc(values(n)), "groups_sha256": row["groups_sha256"]})


def aligned(docs: DataFrame, a_path: str, b_path: str, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best
    (links whose pair no other pair of its second id outnumbers), count_sum (over links,
    their pairs' counts) and groups_sha256.

    Null and empty texts, and those that either tokenizer's bytes don't give back, have
    no tokens: zeros and an empty hash; nothing of them is counted. Rows that
    repeat an id, or have none, each come back. An empty table gives none.

    Counts of up to ``broadcast_pairs`` distinct pairs are broadcast. Beyond, the pairs of
    each part are joined to their counts and brought back to the part, whose size
    is bounded; a frequent pair is one row per part, which Spark splits by itself."""
    parts = stored_parts(docs, a_path, b_path)
    counts = stored(pair_counts(parts), "counts")
    fields = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "chunks", "ends", "pairs", "pair_ends"]
    if counts.count() <= broadcast_pairs:
        some = counts.toPandas().sort_values("pair")
        shared = docs.sparkSession.sparkContext.broadcast(
            tuple(np.ascontiguousarray(some[c].to_numpy()) for c in ("pair", "n", "best")))

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            give_back()
            for batch in batches:
                for row in one_by_one(batch):
                    yield pa.RecordBatch.from_pandas(told(row, *shared.value), preserve_index=False)

        return parts.select(*fields).mapInArrow(task, TOLD)

    def distinct(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in one_by_one(batch):
                keys = np.unique(array_of(row["pairs"], "<i8"))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), row["part"])), pa.array(keys)], ["part", "pair"])

    def bring(part: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        known = known.sort_values("pair")
        found = [told(r, *(known[c].to_numpy() for c in ("pair", "n", "best"))) for r in part.to_dict("records")]
        return pd.concat(found) if found else pd.DataFrame(columns=[c.split(" ")[0] for c in TOLD.split(", ")])

    asked = parts.select("part", "pairs").mapInArrow(distinct, "part bigint, pair bigint").join(counts, "pair")
    return parts.select("part", *fields).groupBy("part").cogroup(asked.groupBy("part")).applyInPandas(bring, TOLD)
