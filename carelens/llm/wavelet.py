"""Operator 13, token ids as binary files: one wavelet matrix per shard.

Documents in ascending order of their id are cut into shards. A shard file holds
the token ids of its documents, end id included, as a wavelet matrix: one bit-plane
per bit of an id, highest first, where the ids whose bit is 0 come before the others
in the next plane. A plane is cut into blocks that are compressed one by one; a
directory has each block's place and the ones before it, so rank and select read one
block. From the file alone come the token at a place (one rank per plane), the number
of times a token occurs, and its places (select upwards), without decoding the rest.

Tasks make the bytes, Spark's own writer puts them in place as one raw file per shard
and its committer deals with lost tasks, so any file system that Spark reaches
will do. A file is self-contained; the manifest beside the files has the first
token's number of every shard.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from carelens.llm.common import scratch, stored, text_of

#: Tokens of a shard, which a task holds while it makes one; a longer document is a shard.
SHARD_TOKENS = 1 << 23
#: Range partitions at most; their token totals, one number each, pass the driver.
MOST_PARTS = 20_000
#: Bits of a block, and ids that are put in order together.
BLOCK, STRETCH = 1 << 16, 1 << 15
END_ID = 2
#: Pieces and words kept in each generation of a worker's cache, and the longest kept.
CACHED, CACHED_CHARS = 400_000, 64
#: Bytes of texts that are encoded together.
TEXT_BYTES = 12_000_000
#: Letters of one lower case and one form, and the ASCII signs after them (no apostrophe,
#: which may belong to the letters): the tokenizer cuts between the two and nowhere else.
LETTERS = "".join(c for c in map(chr, range(256)) if re.fullmatch("[A-Za-zÀ-ÖØ-öø-ÿ]", c))
SIGNS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
PLAIN = f"^[{LETTERS}]+$"
#: How the vocabulary writes the bytes of those letters: a letter for each byte, from
#: 256 on for bytes that have no sign of their own.
OWN_SIGN = [*range(33, 127), *range(161, 173), *range(174, 256)]
OTHERS = [b for b in range(256) if b not in set(OWN_SIGN)]
BYTES = {c: "".join(chr(b if b in OWN_SIGN else 256 + OTHERS.index(b)) for b in chr(c).encode()) for c in range(192, 256)}

HEAD = "<4sHHIIqqIII"
HEAD_BYTES = struct.calcsize(HEAD)
MAGIC, VERSION = b"TKWM", 1


# ---- one shard ----


def halved(ids: np.ndarray, bit: np.ndarray, zeros: int) -> np.ndarray:
    """The ids whose bit is 0 (so many as ``zeros``), then the others. Parts are taken by
    their places, one after the other, so that places and ids stay in the processor's cache."""
    made, low, high = np.empty_like(ids), 0, zeros
    for start in range(0, len(ids), STRETCH):
        some, own = ids[start : start + STRETCH], bit[start : start + STRETCH]
        off, on = np.flatnonzero(~own), np.flatnonzero(own)
        some.take(off, out=made[low : low + len(off)], mode="clip")
        some.take(on, out=made[high : high + len(on)], mode="clip")
        low, high = low + len(off), high + len(on)
    return made


def merged(found: np.ndarray, bit: np.ndarray, zeros: int, value: int) -> np.ndarray:
    """What ``halved`` was given, with ``value`` set in those whose bit is 1."""
    made, low, high = np.empty_like(found), 0, zeros
    for start in range(0, len(found), STRETCH):
        own, some = bit[start : start + STRETCH], made[start : start + STRETCH]
        off, on = np.flatnonzero(~own), np.flatnonzero(own)
        some[off] = found[low : low + len(off)]
        some[on] = found[high : high + len(on)] | found.dtype.type(value)
        low, high = low + len(off), high + len(on)
    return made


def shard_bytes(ids: np.ndarray, planes: int, docs: list[int | None], lengths: list[int], part: int, seq: int) -> bytes:
    """The file of a shard: ``ids`` are the tokens of all its documents, one after
    the other; ``docs`` and ``lengths`` are their ids and numbers of tokens."""
    pack = zstandard.ZstdCompressor(level=1).compress
    table = [
        pack(np.array([d or 0 for d in docs], dtype="<i8").tobytes()),
        pack(np.array([d is None for d in docs], dtype="u1").tobytes()),
        pack(np.array(lengths, dtype="<i8").tobytes()),
    ]
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    zeros, sizes, before, body = [], [], [], []
    for p in range(planes - 1, -1, -1):
        bit = (ids & ids.dtype.type(1 << p)) != 0
        packed = np.zeros(blocks * BLOCK // 8, dtype="u1")
        raw = np.packbits(bit)
        packed[: len(raw)] = raw
        cut = packed.reshape(blocks, BLOCK // 8)
        ones = np.bitwise_count(cut).sum(axis=1, dtype=np.int64)
        zeros.append(n - int(ones.sum()))
        before.append(np.concatenate([[0], np.cumsum(ones)])[:-1])
        made = [pack(b.tobytes()) for b in cut]
        sizes.append([len(m) for m in made])
        body += made
        ids = halved(ids, bit, zeros[-1])
    return b"".join([
        struct.pack(HEAD, MAGIC, VERSION, planes, part, seq, n, len(docs), *map(len, table)), *table,
        np.array(zeros, dtype="<i8").tobytes(), np.array(sizes, dtype="<u4").tobytes(),
        np.array(before, dtype="<i8").tobytes(), *body])


class Shard:
    """A shard file, opened: blocks are decompressed when they are needed."""

    def __init__(self, data: bytes):
        magic, version, self.planes, self.part, self.seq, self.n, n_docs, *sizes = struct.unpack_from(HEAD, data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token shard of this version")
        self.data, self._unpack = data, zstandard.ZstdDecompressor().decompress
        at, table = HEAD_BYTES, []
        for size in sizes:
            table.append(self._unpack(data[at : at + size]))
            at += size
        nulls = np.frombuffer(table[1], dtype="u1")
        self.docs = [None if z else d for d, z in zip(np.frombuffer(table[0], dtype="<i8").tolist(), nulls.tolist(), strict=True)]
        self.lengths = np.frombuffer(table[2], dtype="<i8")
        assert len(self.docs) == n_docs
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)
        blocks = -(-self.n // BLOCK)

        def numbers(kind: str, *shape: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, dtype=kind, count=int(np.prod(shape)), offset=at).reshape(shape)
            at += found.nbytes
            return found

        self.zeros = numbers("<i8", self.planes)
        lengths = numbers("<u4", self.planes, blocks)
        self.before = numbers("<i8", self.planes, blocks)
        self.places = at + np.concatenate([[0], np.cumsum(lengths.ravel(), dtype=np.int64)])
        self._blocks: dict[tuple[int, int], np.ndarray] = {}

    def _block(self, level: int, k: int) -> np.ndarray:
        found = self._blocks.get((level, k))
        if found is None:
            i = level * self.before.shape[1] + k
            found = np.frombuffer(self._unpack(self.data[self.places[i] : self.places[i + 1]]), dtype="u1")
            if len(self._blocks) >= 4096:
                self._blocks.clear()
            self._blocks[level, k] = found
        return found

    def _bits(self, level: int) -> np.ndarray:
        whole = b"".join(self._block(level, k).tobytes() for k in range(self.before.shape[1]))
        return np.unpackbits(np.frombuffer(whole, dtype="u1"), count=self.n).astype(bool)

    def _rank(self, level: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bit at each place, 0 at the end, and the ones before it."""
        bits, ranks = np.zeros(len(places), dtype=bool), np.zeros(len(places), dtype=np.int64)
        block = places // BLOCK
        for k in np.unique(block):
            at = np.flatnonzero(block == k)
            if k == self.before.shape[1]:  # the end of a last block that is full
                ranks[at] = self.n - self.zeros[level]
                continue
            data, off = self._block(level, int(k)), places[at] - k * BLOCK
            sums = np.concatenate([[0], np.cumsum(np.bitwise_count(data), dtype=np.int64)])
            byte, left = data[off >> 3].astype(np.int64), off & 7
            bits[at] = byte >> 7 - left & 1
            ranks[at] = self.before[level, k] + sums[off >> 3] + np.bitwise_count(byte >> 8 - left)
        return bits, ranks

    def _select(self, level: int, bit: int, numbers: np.ndarray) -> np.ndarray:
        """The places of the given ones or zeros of a plane, counted from 0."""
        starts = np.arange(self.before.shape[1], dtype=np.int64) * BLOCK
        before = self.before[level] if bit else starts - self.before[level]
        block = np.searchsorted(before, numbers, side="right") - 1
        out = np.zeros(len(numbers), dtype=np.int64)
        for k in np.unique(block):
            at = np.flatnonzero(block == k)
            places = np.flatnonzero(np.unpackbits(self._block(level, int(k))) == bit)
            out[at] = k * BLOCK + places[numbers[at] - before[k]]
        return out

    def access(self, places) -> np.ndarray:
        """The tokens at some places."""
        places = np.asarray(places, dtype=np.int64)
        if len(places) and (places.min() < 0 or places.max() >= self.n):
            raise IndexError("no such place in this shard")
        found = np.zeros(len(places), dtype=np.int64)
        for level in range(self.planes):
            bits, ranks = self._rank(level, places)
            found = found << 1 | bits
            places = np.where(bits, self.zeros[level] + ranks, places - ranks)
        return found

    def _range(self, token: int, end: int) -> tuple[int, int]:
        """Where in the order below the last plane the token's copies before ``end`` lie."""
        if not 0 <= token < 1 << self.planes:
            return 0, 0
        ends = np.array([0, end], dtype=np.int64)
        for level in range(self.planes):
            _, ranks = self._rank(level, ends)
            ends = self.zeros[level] + ranks if token >> self.planes - 1 - level & 1 else ends - ranks
        return int(ends[0]), int(ends[1])

    def count(self, token: int, end: int | None = None) -> int:
        """How often the token occurs before ``end`` (the whole shard)."""
        low, high = self._range(token, self.n if end is None else end)
        return high - low

    def places_of(self, token: int) -> np.ndarray:
        """All places of the token, ascending."""
        low, high = self._range(token, self.n)
        found = np.arange(low, high, dtype=np.int64)
        for level in range(self.planes - 1, -1, -1):
            bit = token >> self.planes - 1 - level & 1
            found = self._select(level, bit, found - self.zeros[level] if bit else found)
        return found

    def whole(self) -> np.ndarray:
        """All tokens in order: from the last plane up, the two halves of each order
        go back to where its bits say."""
        kind = np.uint16 if self.planes <= 16 else np.uint32
        found = np.zeros(self.n, dtype=kind)
        for level in range(self.planes - 1, -1, -1):
            found = merged(found, self._bits(level), int(self.zeros[level]), 1 << self.planes - 1 - level)
        return found


# ---- encoding ----


class Kept(dict):
    """What ``learn`` tells of a key, kept in two generations: the older is dropped
    when the younger is full, and what is asked for again moves to the younger."""

    def __init__(self, learn, most: int):
        self.learn, self.most, self.old = learn, most, {}

    def __missing__(self, key: str) -> bytes:
        found = self.old.get(key)
        if found is None:
            found = self.learn(key)
        if len(key) <= CACHED_CHARS:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = found
        return found


class PieceEncoder:
    """The library's ids of texts, as little-endian bytes. No token, and nothing that
    normalisation joins, crosses an ASCII space, tab or line end, so a text is
    the sequence of the pieces between them, and a piece is encoded once. Of pieces that
    are letters and signs after them the library's model alone encodes each of the two
    (they are already what normalisation and cutting make of them)."""

    def __init__(self, model: str):
        self.library = Tokenizer.from_str(model)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        most = max(max(self.library.get_vocab().values()), END_ID)
        self.planes = most.bit_length()
        self.kind = np.dtype("<u2" if self.planes <= 16 else "<u4")
        # cutting and lower case are of this kind of tokenizer; others go through the library whole
        self.plain = self._ask("Word,") == self._ask("word") + self._ask(",") and self._model("word") == self._ask("word")
        self.words = Kept(self._model, CACHED)
        self.pieces = Kept(self._ask, CACHED)
        self.words[""] = self.pieces[""] = b""

    def _ask(self, piece: str) -> bytes:
        return array(self.kind.char, self.library.encode(piece, add_special_tokens=False).ids).tobytes()

    def _model(self, word: str) -> bytes:
        shown = word if word.isascii() else word.translate(BYTES)
        return array(self.kind.char, [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _found(self, kept: Kept, keys: pa.Array) -> pa.Array:
        """The ids of each key, of which distinct ones are looked up once."""
        keys = keys.dictionary_encode()
        known = map(kept.__getitem__, keys.dictionary.to_numpy(zero_copy_only=False))
        return pa.array(list(known), pa.large_binary()).take(keys.indices)

    def _pieces(self, pieces: pa.Array) -> pa.Array:
        """The ids of distinct pieces. Arrow tells letters from the signs after them."""
        letters = pc.utf8_rtrim(pieces, characters=SIGNS)
        plain = pc.match_substring_regex(letters, PLAIN)
        if not self.plain:
            plain = pc.and_(plain, False)
        some = pieces.filter(plain)
        # words and signs are looked up in turn, each once
        words = self._found(self.words, pa.concat_arrays([
            pc.utf8_lower(letters.filter(plain)), pc.utf8_ltrim(some, characters=LETTERS)]))
        both = pc.binary_join_element_wise(words[: len(some)], words[len(some) :], pa.scalar(b"", words.type))
        told = pc.replace_with_mask(pa.nulls(len(pieces), both.type), plain, both)
        other = pc.invert(plain)
        return pc.replace_with_mask(told, other, self._found(self.pieces, pieces.filter(other)))

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text. Texts are cut and their distinct pieces found by Arrow;
        only those are looked up, and their ids then copied to each place."""
        for sign in "\n\t\r":
            texts = pc.replace_substring(texts, sign, " ")
        cut = pc.split_pattern(texts, " ")
        found = cut.flatten().dictionary_encode()
        whole = self._pieces(found.dictionary).take(found.indices)
        _, places, data = whole.buffers()
        ends = np.frombuffer(places, dtype=np.int64)[whole.offset :][cut.offsets.to_numpy() - cut.offsets[0].as_py()].tolist()
        data = memoryview(data or b"")
        return [bytes(data[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def encoder_of(shared: dict) -> PieceEncoder:
    """The encoder of a broadcast vocabulary, made once in each Python worker."""
    if "pieces" not in shared:
        shared["pieces"] = PieceEncoder(shared["model"])
    return shared["pieces"]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, the ids as bytes and their number, end id included, in a stored table
    whose rows have a number of their own."""
    with open(path, encoding="utf-8") as f:
        model = docs.sparkSession.sparkContext.broadcast({"model": f.read()})

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model.value)
        end = np.array([END_ID], dtype=encoder.kind).tobytes()
        for batch in batches:
            ids, texts = [], batch.column(1)
            for some in slices(texts):
                ids += [x + end for x in encoder.encode(some)]
            sizes = [len(x) // encoder.kind.itemsize for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary()), pa.array(sizes, pa.int64())], ["doc_id", "ids", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    made = rows.mapInArrow(task, "doc_id bigint, ids binary, n_tokens bigint")
    return stored(made.withColumn("own", F.monotonically_increasing_id()), "ids")


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Parts of a column of texts of some ten million bytes, or one longer text."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        base = int(ends[at - 1]) if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, base + TEXT_BYTES, side="right")))
        yield texts.slice(at, upto - at)
        at = upto


# ---- all shards ----


def write_shards(docs: DataFrame, tokenizer: str, folder: str, shard_tokens: int = SHARD_TOKENS) -> None:
    """Writes the token ids of ``docs`` (doc_id, text) to ``folder``/shards, one file
    per shard, in ascending order of doc_id, those without id first, repeated ids
    one after the other. A null or empty text has the end id alone."""
    with open(tokenizer, encoding="utf-8") as f:
        model = PieceEncoder(f.read())
    planes, kind = model.planes, model.kind.str
    rows = encoded(docs, tokenizer)
    total = rows.agg(F.sum("n_tokens")).first()[0] or 0
    parts = int(min(MOST_PARTS, max(1, -(-total // shard_tokens))))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, docs, lengths, held, n = TaskContext.get().partitionId(), 0, [], [], [], 0

        def file() -> pa.RecordBatch:
            ids = np.concatenate([np.frombuffer(b, dtype=kind) for b in held])
            return pa.RecordBatch.from_pydict({"file": pa.array([shard_bytes(ids, planes, docs, lengths, part, seq)], pa.binary())})

        for batch in batches:
            for doc, ids, size in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if n and n + size > shard_tokens:
                    yield file()
                    seq, docs, lengths, held, n = seq + 1, [], [], [], 0
                docs.append(doc)
                lengths.append(size)
                held.append(ids)
                n += size
        if n:
            yield file()

    files = rows.repartitionByRange(parts, "doc_id", "own").sortWithinPartitions("doc_id", "own").select(
        "doc_id", "ids", "n_tokens").mapInArrow(shards, "file binary")
    # one raw file per row: the text writer passes bytes on as they are and adds a line end, which readers don't reach
    files.select(F.col("file").cast("string")).write.option("maxRecordsPerFile", 1).text(f"{folder}/shards")


class TokenShards:
    """The files that ``write_shards`` made, read back."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _shards(self, read, schema: str) -> DataFrame:
        """``read`` on each opened shard, which returns a frame of the schema."""

        def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for data in batch["content"]:
                    yield read(Shard(data))

        # a file's length is read first and files of no shard are left out
        files = self.spark.read.format("binaryFile").load(f"{self.folder}/shards")
        return files.where(F.col("length") > HEAD_BYTES).select("content").mapInPandas(task, schema)

    def read(self) -> DataFrame:
        """part, seq, doc_id, at (ids of the shard before the document), n_tokens and
        ids_crc32 of every document, from its decoded tokens."""

        def read(shard: Shard) -> pd.DataFrame:
            ids, at = shard.whole().astype("<u4"), shard.starts.tolist()
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at, at[1:], strict=False)]
            return pd.DataFrame({
                "part": shard.part, "seq": shard.seq, "doc_id": pd.array(shard.docs, dtype="Int64"), "at": at[:-1],
                "n_tokens": shard.lengths, "ids_crc32": crc})

        return self._shards(read, "part int, seq int, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint")

    @staticmethod
    def manifest(read: DataFrame) -> DataFrame:
        """part, seq, first (ids of all shards before it), n_docs and n_tokens of
        each shard. The totals of the parts, a bounded number, are added on the driver."""
        spark = read.sparkSession
        shards = read.groupBy("part", "seq").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        found = sorted(tuple(r) for r in shards.groupBy("part").agg(F.sum("n_tokens")).collect())
        sums = np.cumsum([0, *[n for _, n in found]]).tolist()
        parts = spark.createDataFrame([(p, s) for (p, _), s in zip(found, sums, strict=False)], "part int, base bigint")
        earlier = W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
        return shards.withColumn("inner", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0))).join(
            F.broadcast(parts), "part").select("part", "seq", (F.col("base") + F.col("inner")).alias("first"), "n_docs", "n_tokens")

    def documents(self) -> DataFrame:
        """doc_id, start, n_tokens and ids_crc32 of every document."""
        read = stored(self.read(), "read")
        return read.join(self.manifest(read).select("part", "seq", "first"), ["part", "seq"]).select(
            "doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")

    def counts(self, tokens: list[int]) -> DataFrame:
        """How often each of some tokens occurs in all shards, by rank alone."""
        def read(shard: Shard) -> pd.DataFrame:
            return pd.DataFrame({"token": tokens, "n": [shard.count(t) for t in tokens]})

        return self._shards(read, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))

    def occurrences(self, token: int) -> DataFrame:
        """doc_id and at (from 0, within the document) of each place of a token, by select."""
        def read(shard: Shard) -> pd.DataFrame:
            places = shard.places_of(token)
            doc = np.searchsorted(shard.starts, places, side="right") - 1
            return pd.DataFrame({
                "doc_id": pd.array([shard.docs[d] for d in doc.tolist()], dtype="Int64"), "at": places - shard.starts[doc]})

        return self._shards(read, "doc_id bigint, at bigint")

    def tokens_at(self, places: DataFrame) -> DataFrame:
        """doc_id, at and token for the rows (doc_id, at) asked for, by rank; places beyond
        a document's end are left out. A shard looks up only its own documents'
        rows: the questions are grouped by document, then by the shard's place table."""
        read = stored(self.read().select("part", "seq", "doc_id", F.col("at").alias("first"), "n_tokens"), "places")
        asked = places.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("at").cast("long").alias("at")).join(read, "doc_id").where(
            "at >= 0 and at < n_tokens").select("part", "seq", "doc_id", "at", (F.col("first") + F.col("at")).alias("place"))

        def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for data in batch["content"]:
                    shard = Shard(data)
                    yield pd.DataFrame({"part": [shard.part], "seq": [shard.seq], "content": [data]})

        files = self.spark.read.format("binaryFile").load(f"{self.folder}/shards").where(F.col("length") > HEAD_BYTES)
        files = files.select("content").mapInPandas(whole, "part int, seq int, content binary")

        def look(asked: pd.DataFrame, file: pd.DataFrame) -> pd.DataFrame:
            if not len(file) or not len(asked):
                return pd.DataFrame({"doc_id": [], "at": [], "token": []}).astype("int64")
            tokens = Shard(file["content"].iloc[0]).access(asked["place"].to_numpy())
            return pd.DataFrame({"doc_id": asked["doc_id"], "at": asked["at"], "token": tokens})

        return asked.groupBy("part", "seq").cogroup(files.groupBy("part", "seq")).applyInPandas(look, "doc_id bigint, at bigint, token bigint")


def shards_digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes ``docs`` to shards in a new shared folder and reads every document back:
    doc_id, start, n_tokens and ids_crc32 (of the ids as little-endian 32-bit numbers).
    Empty tables write no shard."""
    folder = scratch(docs.sparkSession, "shards")
    write_shards(docs.select("doc_id", "text"), tokenizer, folder)
    return TokenShards(docs.sparkSession, folder).documents()
