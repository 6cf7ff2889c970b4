import random
import zlib

import numpy as np
from llm_fixtures import docs  # noqa: F401

from carelens.llm import language
from carelens.llm.common import table
from carelens.llm.language import WIDTH, fit, fit_kernel, identify, language_digest, presence, vectors


def grams(text, n):
    text = text.lower()
    return {text[i : i + n] for i in range(len(text) - n + 1)}


def test_kernel_is_the_mean_of_the_cosines():
    a, b = "The cat sat on the mat", "THE dog sat on a log"
    x = vectors([a, b])
    want = np.mean([len(grams(a, n) & grams(b, n)) / np.sqrt(len(grams(a, n)) * len(grams(b, n))) for n in (1, 2, 3)])
    assert abs(float(x[0] @ x[1]) - want) < 0.03  # hashed, so a little above
    assert abs(float(x[0] @ x[0]) - 1) < 1e-5


def test_long_texts_are_read_whole(monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(5000))
    whole, pieces = np.zeros(WIDTH), np.zeros(WIDTH)
    presence(text, whole)
    monkeypatch.setattr(language, "CHARS", 64)
    presence(text, pieces)
    assert (whole == pieces).all()


def test_ridge_regression_equals_its_dense_form():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, 12))
    lang = np.array(["a", "b"])[(x[:, 0] > 0).astype(int)]
    model = fit_kernel(x, lang, ridge=1e-3)
    y = np.where(lang[:, None] == np.array(["a", "b"]), 1.0, -1.0)
    weight = 1 / np.array([np.count_nonzero(lang == g) for g in lang])
    w = np.linalg.solve(x.T @ (x * weight[:, None]) + 1e-3 * np.eye(12), x.T @ (y * weight[:, None]))  # all landmarks: a linear kernel
    assert np.allclose(model.scores(x), x @ w, atol=1e-3)


def test_held_out_accuracy(spark):
    rows = table(spark, "/root/testdata/sf0.01", "documents")
    told = language_digest(rows).join(rows.select("doc_id", "lang"), "doc_id").collect()
    aside = [r for r in told if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in told)
    assert np.mean([r["lang"] == r["lang_pred"] for r in aside]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in told)


def test_edges(docs):  # noqa: F811
    words = {"en": "the and of to in that is was he for it with as his on be at by", "de": "der die und das nicht ist ein mit sich auf für"}
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(words[g].split()) for _ in range(30)), g, "s") for i, g in enumerate(["en", "de"] * 40)]
    extra = [(500, None, "en", "s"), (501, "", "de", "s"), (502, "123 !?", "de", "s"), (503, "the and " * 100_000, None, None),
             (504, "der die und das " * 9, None, "s"), (504, "der die und das " * 9, None, "s"), (None, "the and of to", "en", "s")]
    told = language_digest(docs(rows + extra, extra=True)).collect()
    assert len(told) == len(rows + extra)
    got = {}
    for r in told:
        got.setdefault(r["doc_id"], set()).add((r["lang_pred"], r["score"]))
    assert got[500] == got[501] == got[502] == {("und", 0.0)}
    assert {x[0] for x in got[503]} == {"en"} and {x[0] for x in got[504]} == {"de"} and len(got[504]) == 1
    assert {x[0] for x in got[None]} == {"en"}
    nothing = docs([(1, "the", None, None)])
    assert fit(nothing) is None and [r["lang_pred"] for r in identify(nothing, None).collect()] == ["und"]
    assert language_digest(docs([])).collect() == []
