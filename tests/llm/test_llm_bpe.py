import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from carelens.llm import bpe
from carelens.llm.bpe import TrieEncoder, encode, encode_digest
from carelens.llm.queries import TOKENIZER
from llm_fixtures import docs  # noqa: F401

MODEL = open(TOKENIZER, encoding="utf-8").read()
LIBRARY, OWN = Tokenizer.from_str(MODEL), TrieEncoder(MODEL)


def same(texts):
    for text, (ids, decoded, n) in zip(texts, OWN.encode_texts(texts), strict=True):
        want = LIBRARY.encode(text, add_special_tokens=False).ids
        assert ids == " ".join(map(str, want)) and n == len(want), text
        assert decoded == LIBRARY.decode(want, skip_special_tokens=False), text


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=30), max_size=5))
def test_any_text(texts):
    same(texts)


def test_spaces_marks_and_special_tokens():
    rng = random.Random(3)
    signs = list("abcdeABCÉéßΣςσİı 　́̈\x1c\x85\t\n\r\x0b\x0c'sreLL0123４５²中文本😀🏽‍…-!?") + [
        "<|endoftext|>", "<|startoftext|>", "<|", "'ll", "the", " "]
    same(["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(2000)])
    same(["", " ", "\n\n", "x" * 5000, "aaaa " * 3000, "a" * 300 + " " + "b!" * 500])


def test_words_are_encoded_once_with_shared_prefixes():
    words = [w[:-1] + chr(256 + ord(w[-1])) for w in ("the", "then", "thenceforth", "theory", "a")]
    got = OWN.encode_words(words)
    assert set(got) == set(words)
    assert [LIBRARY.encode(w, add_special_tokens=False).ids for w in ("the", "then", "thenceforth", "theory", "a")] == [got[w] for w in words]


def test_small_caches_change_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 5)
    monkeypatch.setattr(bpe, "TEXTS", 2)
    rng = random.Random(8)
    same([" ".join(rng.choice("ab") * rng.randint(1, 9) + rng.choice(["", "!", "é", "1"]) for _ in range(rng.randint(0, 12))) for _ in range(300)])


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 2000)
    monkeypatch.setattr(bpe, "CHARS", 20_000)
    monkeypatch.setattr(bpe, "PAIRS", 3000)
    rng, own = random.Random(4), TrieEncoder(MODEL)
    often = ["".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(50)]
    texts = [" ".join([*often, *("".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(50))]) for _ in range(2000)]
    sizes = []
    for text, (ids, decoded, n) in zip(texts, own.encode_texts(texts), strict=True):
        sizes.append(max(map(len, (own.kept, own.kept_before, own.words, own.words_before))))
    # 100,000 words stand in one text only; a stretch has at most 20,000 code points, under 2,100 words
    assert max(sizes) <= 2000 + 2100 and len(own.follows) <= 3000
    assert set(often) <= own.kept.keys() | own.kept_before.keys()
    assert not own.kept.keys() & set(texts[0].split()[50:])
    assert ids == " ".join(map(str, LIBRARY.encode(texts[-1], add_special_tokens=False).ids))


def test_stretches_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "TEXTS", 3)
    monkeypatch.setattr(bpe, "CHARS", 10)
    texts = ["a" * 4, "b" * 4, "c" * 4, "d" * 50, "", "e", "f", "g" * 10]
    assert [len(x) for x in bpe.stretches(texts)] == [2, 1, 1, 3, 1]
    assert [t for x in bpe.stretches(texts) for t in x] == texts
    assert list(bpe.stretches([])) == []


def test_rows_are_taken_a_few_at_once(docs):
    from carelens.llm.common import carrying, mapped

    rows = carrying(docs([(k, "x" * k) for k in range(25)]).coalesce(1), ["doc_id"], "text")
    told = mapped(rows, lambda: lambda texts: ([len(texts)] * len(texts), map(len, texts)), {"n": "bigint", "size": "bigint"}, 10)
    got = told.select("row.doc_id", "n", "size").collect()
    assert sorted(r["doc_id"] for r in got) == list(range(25)) and all(r["doc_id"] == r["size"] for r in got)
    assert max(r["n"] for r in got) <= 10


def test_table(docs):
    rows = [(1, "Hello, world! " * 500), (2, None), (3, ""), (4, "same"), (4, "same"), (None, "no id")]
    told = encode_digest(docs(rows, extra=True), TOKENIZER).collect()
    want = []
    for doc_id, text in rows:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, told), key=repr) == sorted(want, key=repr)
    whole = encode(docs(rows, extra=True), TOKENIZER)
    assert {r["row"]["a b"] for r in whole.collect()} == {"x1", "x2", "x3", "x4", None}
    assert encode_digest(docs([]), TOKENIZER).collect() == []
