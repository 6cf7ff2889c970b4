import hashlib
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SMALL, docs, told  # noqa: F401
from tokenizers import Tokenizer

from carelens.llm import alignment
from carelens.llm.alignment import BYTE_OF, Aligner, aligned, aligned_groups, labels
from carelens.llm.common import table
from carelens.llm.queries import BYTE_TOKENIZER, PIECE_TOKENIZER, op12_token_alignment

A = Tokenizer.from_file(BYTE_TOKENIZER)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PIECE_TOKENIZER)
A_BYTES = {i: bytes(BYTE_OF[s] for s in t) for t, i in A.get_vocab().items() if all(s in BYTE_OF for s in t)}


def b_bytes(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def tokens(text):
    """(id, start, end) of both kinds, from whole texts; nothing where bytes differ."""
    out = []
    for ids, of in ((A.encode(" " + (text or ""), add_special_tokens=False).ids, A_BYTES.__getitem__), (B.encode(text or ""), b_bytes)):
        at, found, whole = 0, [], b""
        for i in ids:
            found.append((i, at, at + len(of(i))))
            at, whole = found[-1][2], whole + of(i)
        if not text or whole != (" " + text).encode():
            return [], []
        out.append(found)
    return out


def groups(a, b):
    cuts = sorted({e for *_, e in a} & {e for *_, e in b})
    out, start = [], 0
    for cut in cuts:
        out.append("|".join(",".join(str(i) for i, s, e in side if start <= s and e <= cut) for side in (a, b)))
        start = cut
    return out


def links(a, b):
    """All pairs, by two pointers."""
    out, j = [], 0
    for i, s, e in a:
        while b[j][2] <= s:
            j += 1
        k = j
        while k < len(b) and b[k][1] < e:
            out.append((i, b[k][0]))
            k += 1
    return out


def brute(rows):
    made = [(doc, *tokens(text)) for doc, text in rows]
    linked = [links(a, b) for _, a, b in made]
    count = Counter(x for ls in linked for x in ls)
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for (doc, a, b), ls in zip(made, linked, strict=True):
        gs = groups(a, b)
        out.append((doc, len(a), len(b), len(gs), len(ls), sum(count[x] == best[x[1]] for x in ls), sum(count[x] for x in ls),
                    hashlib.sha256(";".join(gs).encode()).hexdigest() if a else ""))
    return sorted(out, key=repr)


ODD = [
    (1, "Hello, world! don't  stop"), (2, None), (3, ""), (4, " two  leading\n\n and\t tabs \r\n x "), (5, "same text"), (5, "same text"),
    (None, "no id"), (6, "under▁line word"), (7, "İ́ Σς <|endoftext|> <s> x\x1c y\x85 z　 　q 中文 本 😀🏽   a"), (8, " "), (9, "a" * 700 + " b" * 300),
    (10, "\x00 nul \x00"), (11, "  line  sep"), (12, ";\r ▁ {\r\n }"), (13, "12 345's we'll THE")]


def test_labels_follow_common_ends():
    rng = np.random.default_rng(2)
    for n in (1, 2, 5, 60, 400):
        a, b = (np.unique(np.append(rng.integers(1, n + 1, n // 2), n)) for _ in range(2))
        terminal, ag, bg = labels(a, b)
        cuts = np.intersect1d(a, b)
        assert (b[terminal] == cuts).all()
        assert (ag == np.searchsorted(cuts, a)).all() and (bg == np.searchsorted(cuts, b)).all()


@pytest.mark.parametrize("limit", [10**6, 0])
def test_odd_texts_counted_by_broadcast_and_by_join(docs, limit):
    rng = random.Random(4)
    signs = [*"abcdeABCÉéßΣςİ \t\n\r.,'!?-_`{}12", " the", " of", "  ", "中", "▁", "<0x41>", "<unk>", "  ", "😀"]
    rows = ODD + [(100 + i, "".join(rng.choice(signs) for _ in range(rng.randint(1, 40)))) for i in range(120)]
    got = aligned(docs(rows, extra=True), BYTE_TOKENIZER, PIECE_TOKENIZER, limit).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=30), max_size=5))
def test_any_text_is_cut_into_chunks_as_a_whole(texts):
    import pyarrow as pa

    own = OWN.setdefault("aligner", None) or Aligner(open(BYTE_TOKENIZER, encoding="utf-8").read(), open(PIECE_TOKENIZER, "rb").read())
    OWN["aligner"] = own
    got = {}
    for row in own.parts(pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string()), True):
        got |= dict(zip(row["doc_id"], row["groups_sha256"], strict=True))
    assert [got[i] for i in range(len(texts))] == [";".join(groups(*tokens(t))) for t in texts]


OWN: dict = {}


def test_groups_and_no_rows(docs):
    got = told(aligned_groups(docs(ODD[:6]), BYTE_TOKENIZER, PIECE_TOKENIZER), "doc_id", "groups")
    assert got == sorted([(d, ";".join(groups(*tokens(t)))) for d, t in ODD[:6]], key=repr)
    assert aligned(docs([]), BYTE_TOKENIZER, PIECE_TOKENIZER).collect() == []


def test_whole_table(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op12_token_alignment(spark, SMALL).collect()), key=repr) == brute(rows)


def own_aligner():
    own = Aligner(open(BYTE_TOKENIZER, encoding="utf-8").read(), open(PIECE_TOKENIZER, "rb").read())
    return own, lambda texts: own.parts(pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string()))


def test_words_of_one_part_are_not_kept(monkeypatch):
    monkeypatch.setattr(alignment, "CACHED", 400)
    monkeypatch.setattr(alignment, "TEXT_BYTES", 3000)
    rng, (own, parts) = random.Random(4), own_aligner()
    often = ["".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(50)]
    texts = [" ".join([*often, *("".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(50))]) for _ in range(300)]
    sizes = [max(len(own.new), len(own.old)) for _ in parts(texts)]
    assert len(sizes) >= 100 and max(sizes) <= 400 + 200
    assert set(often) <= own.new.keys() | own.old.keys()
    once = {w for t in texts for w in t.split()[50:]}
    assert len(once & (own.new.keys() | own.old.keys())) < 200  # some take a place in ``Seen`` that another has


def test_parts_take_texts_as_they_come(monkeypatch):
    monkeypatch.setattr(alignment, "TEXT_BYTES", 40)
    _, parts = own_aligner()
    texts = ["one two three", "two  spaces", "", "four", " x" * 40, " y", "  z", "end"]
    rows = list(parts(texts))
    assert [sorted(r["doc_id"]) for r in rows] == [[0, 1, 2, 3], [4], [5, 6, 7]]
    got = {d: (a, b) for r in rows for d, a, b in zip(r["doc_id"], r["n_a"], r["n_b"], strict=True)}
    assert got == {i: tuple(map(len, tokens(t))) for i, t in enumerate(texts)}


def test_memory_does_not_grow_with_a_batch():
    rng, (_, parts) = random.Random(4), own_aligner()
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=1000)) for _ in range(800)]  # 5.6 MB
    for _ in parts(texts[:50]):
        pass
    tracemalloc.start()
    try:
        for _ in parts(texts):
            pass
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 40e6
