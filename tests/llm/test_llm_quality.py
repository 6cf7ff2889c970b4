import random
import re
from collections import Counter

import numpy as np
import pytest

from carelens.llm import quality
from carelens.llm.quality import COUNTS, fit, fit_trees, judge, quality_digest, statistics
from llm_fixtures import docs  # noqa: F401


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)]


def texts():
    rng = random.Random(2)
    parts = ["a", "bb", "é", "中", " ", "\n", "\t", "\x0b", " ", "a b c d e ", "x\ny\n", "#", "|", "😀", "\r\n"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 80))) for _ in range(400)] + ["", "w " * 30_000]


def test_counts():
    for text in texts():
        assert statistics(text)[0] == brute(text), repr(text)


def test_trees_keep_their_constraints_and_their_flat_form():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 3))
    y = ((x[:, 0] + np.sin(4 * x[:, 1]) + 0.3 * rng.normal(size=3000)) > 0).astype(float)
    trees = fit_trees(x, y, [1, 0, -1], rounds=30)
    assert np.mean((trees.margin(x) > 0) == (y > 0)) > 0.9
    points = np.repeat(rng.normal(size=(200, 3)), 50, axis=0)
    for f, sign in ((0, 1), (2, -1)):
        at = points.copy()
        at[:, f] = np.tile(np.linspace(-3, 3, 50), 200)
        steps = np.diff(trees.margin(at).reshape(200, 50), axis=1) * sign
        assert steps.min() > -1e-9
    row, total = x[7], trees.base  # the arrays, followed one node at a time
    for root in trees.roots:
        node = root
        while trees.left[node] != node:
            node = trees.left[node] if row[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
        total += trees.value[node]
    assert trees.margin(x[7:8])[0] == pytest.approx(total)


def test_table(spark, docs):
    good = [(i, " ".join(f"word{i}x{k} of" for k in range(20)) + ".") for i in range(120)]
    bad = [(200 + i, " ".join(f"W{i}Q{k}###" for k in range(30))) for i in range(120)]
    other = [(500, None), (501, ""), (502, "few words"), (503, "same five words again here " * 30), (504, "w%d " * 20_000), (None, "x y")]
    rows = docs(good + bad + other + [good[0]], extra=True)
    labels = spark.createDataFrame(
        [(i, 1, 0) for i, _ in good[::2]] + [(i, 0, 0) for i, _ in bad[::2]] + [(999, 1, 0), (None, 0, 0), (3, None, 0)],
        "doc_id long, quality int, toxic int")
    told = quality_digest(rows, labels).collect()
    assert len(told) == len(good + bad + other) + 1
    text_of = dict(good + bad + other)
    for r in told:
        want = brute(text_of[r["doc_id"]] or "")
        assert [r[c] for c in COUNTS] == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r["kept"] and r["base_failed"])
    kept = {r["doc_id"] for r in told if r["kept"]}
    assert {i for i, _ in good} <= kept and not {i for i, _ in bad} & kept


def test_without_labels_the_rules_decide(spark, docs):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = docs([(1, "one two three four five six seven eight nine ten"), (2, "few")])
    assert fit(rows, empty) is None
    assert {r["doc_id"]: r["kept"] for r in quality_digest(rows, empty).collect()} == {1: True, 2: False}
    assert judge(docs([]), None).collect() == [] and quality.SAMPLE_PER_LABEL > 0
