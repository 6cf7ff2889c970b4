import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import SMALL, docs, told  # noqa: F401
from tokenizers import Tokenizer

from carelens.llm.common import scratch, table
from carelens.llm.queries import TOKENIZER, op13_token_shards
from carelens.llm import wavelet
from carelens.llm.wavelet import BLOCK, Shard, TokenShards, shard_bytes, shards_digest, write_shards

LIBRARY = Tokenizer.from_file(TOKENIZER)


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]


def wanted(rows):
    """(doc_id, start, n_tokens, crc) of rows in ascending order, those without id first."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = ids_of(text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("n, planes", [(1, 1), (7, 3), (BLOCK, 5), (BLOCK * 2 + 77, 16), (1000, 20)])
def test_shard_access_counts_and_places(n, planes):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % (1 << planes)).astype(np.uint32)
    shard = Shard(shard_bytes(ids, planes, [5, None], [n - 1, 1], 3, 4) + b"\n")
    assert (shard.part, shard.seq, shard.docs, shard.lengths.tolist()) == (3, 4, [5, None], [n - 1, 1])
    assert (shard.whole() == ids).all()
    places = rng.integers(0, n, 200)
    assert (shard.access(places) == ids[places]).all()
    for token in {int(ids[0]), int(ids[-1]), 0, (1 << planes) - 1}:
        assert (shard.places_of(token) == np.flatnonzero(ids == token)).all()
        for end in (0, n // 2, n):
            assert shard.count(token, end) == int((ids[:end] == token).sum())
    assert shard.count(1 << planes) == 0 and not len(shard.places_of(-1))
    with pytest.raises(IndexError):
        shard.access([n])


def test_whole_table(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    got = op13_token_shards(spark, SMALL).collect()
    assert sorted(map(tuple, got)) == wanted(rows)


def test_odd_rows_and_many_shards(spark, docs):
    odd = "İ́ Σς <|endoftext|> x\x1cy\x85z 　 don't THE,the;The!? " * 3
    rows = [(9, "last"), (1, "Hello, world! " * 400), (4, None), (2, ""), (7, odd), (3, "x" * 3000), (-5, "\t\n"), (8, "a\rb c")]
    table = docs(rows, extra=True).withColumnRenamed("path", "ids")
    folder = scratch(spark, "files")
    write_shards(table, TOKENIZER, folder, shard_tokens=50)
    shards = TokenShards(spark, folder)
    assert sorted(map(tuple, shards.documents().collect())) == wanted(rows)
    manifest = shards.manifest(shards.read()).orderBy("first").collect()
    assert len(manifest) >= 6 and sum(r["n_docs"] for r in manifest) == len(rows)
    assert [r["first"] for r in manifest][1:] == list(np.cumsum([r["n_tokens"] for r in manifest])[:-1])
    everything = [(d, i, t) for d, text in rows for i, t in enumerate(ids_of(text))]
    token = LIBRARY.encode("world", add_special_tokens=False).ids[0]
    assert told(shards.occurrences(token), "doc_id", "at") == sorted(
        [(d, i) for d, i, t in everything if t == token], key=repr)
    assert dict(map(tuple, shards.counts([token, 2, 48000]).collect())) == {
        t: sum(x == t for *_, x in everything) for t in (token, 2, 48000)}
    asked = spark.createDataFrame([(1, 0), (1, 900), (7, 3), (2, 0), (2, 1), (99, 0)], "doc_id long, at long")
    assert {tuple(r) for r in shards.tokens_at(asked).collect()} == {
        x for x in everything if x[:2] in {(1, 0), (1, 900), (7, 3), (2, 0)}}


def test_repeated_missing_and_no_rows(docs):
    rows = [(None, "no id"), (3, "same"), (3, "same"), (3, "other words"), (None, None)]
    got = sorted([tuple(r) for r in shards_digest(docs(rows), TOKENIZER).collect()], key=lambda r: r[1])
    want = wanted(rows)
    assert [r[0] for r in got] == [r[0] for r in want] and sorted(r[2:] for r in got) == sorted(r[2:] for r in want)
    assert all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:], strict=False))
    assert shards_digest(docs([]), TOKENIZER).collect() == []


def test_planes_are_halved_and_merged_in_stretches(monkeypatch):
    monkeypatch.setattr(wavelet, "STRETCH", 8)
    rng = np.random.default_rng(4)
    for n in (0, 1, 7, 8, 9, 64, 100):
        for share in (0, 0.3, 1):
            ids = rng.integers(0, 1 << 15, n).astype("<u2")
            bit = rng.random(n) < share
            zeros = n - int(np.count_nonzero(bit))
            low = wavelet.halved(ids, bit, zeros)
            assert low.tolist() == [*ids[~bit].tolist(), *ids[bit].tolist()]
            assert wavelet.merged(low, bit, zeros, 1 << 15).tolist() == np.where(bit, ids | 1 << 15, ids).tolist()


def test_letters_and_signs_are_told_apart_for_all_pieces_together():
    """Ids are the library's; pieces of letters and signs aren't looked up and kept one by one."""
    with open(TOKENIZER, encoding="utf-8") as f:
        encoder = wavelet.PieceEncoder(f.read())
    rng = random.Random(9)
    signs = ["a", "É", "ß", "Ÿ", "×", "'s", "'", "9", ",", "!!", "_", " ", "  ", "\n", "\t", "\r", "日", "́", "µ", "\x0b", "x" * 70]
    texts = ["", " ", "".join(signs), *("".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(300))]
    got = [np.frombuffer(x, dtype=encoder.kind).tolist() for x in encoder.encode(pa.array(texts))]
    assert got == [encoder.library.encode(t, add_special_tokens=False).ids for t in texts]
    assert encoder.encode(pa.array(texts).slice(2, 1)) == encoder.encode(pa.array(texts[2:3])) and encoder.encode(pa.array([""])) == [b""]
    encoder.pieces.clear()
    encoder.encode(pa.array(["Word, word! wörd it's 9"]))
    assert set(encoder.pieces) == {"it's", "9"}
