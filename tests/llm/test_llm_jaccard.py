import random

import numpy as np
import pytest
from llm_fixtures import docs  # noqa: F401

from carelens.llm import common, jaccard
from carelens.llm.components import components
from carelens.llm.jaccard import common_shingles, near_documents, shared_depth, without_near_copies


def sets(text):
    words = (text or "").split(" ")
    words = [w for w in words if w]
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    shingles = [sets(t) for _, t in rows]
    links = [set() for _ in rows]
    for i, a in enumerate(shingles):
        for j, b in enumerate(shingles):
            if i != j and a and b and rows[i][0] is not None and rows[j][0] is not None:
                both = len(a & b)
                if 10 * both >= 8 * (len(a) + len(b) - both):
                    links[i].add(j)
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out.append((rows[i][0], len(links[i]), min(rows[j][0] for j in seen) if rows[i][0] is not None else None))
    return out


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    rows = []
    for _ in range(25):
        base = [word() for _ in range(rng.randint(40, 300))]
        for _ in range(rng.randint(1, 8)):
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = word()
            rows.append((len(rows), " ".join(text)))
    hot = [word() for _ in range(150)]
    for _ in range(60):  # a large group of near copies
        text = list(hot)
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(150)] = word()
        rows.append((len(rows), " ".join(text)))
    rows += [(len(rows) + k, rows[-1][1]) for k in range(20)]  # and of exact ones
    top = len(rows)
    rows += [(top, None), (top + 1, ""), (top + 2, " "), (top + 3, "three short words"), (top + 4, "three short words"),
             (top + 5, "three short word"), (top + 6, "x"), (None, rows[0][1]), (top + 7, "many " * 20_000), (top + 8, "many " * 9)]
    return rows


@pytest.mark.parametrize("block", [128, 9])
def test_like_all_pairs(docs, monkeypatch, block):  # noqa: F811
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = corpus()
    got = near_documents(docs(rows, extra=True)).collect()
    want = {r: (n, c) for r, n, c in brute(rows)}
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_links"], r["component_id"]) == want[r["doc_id"]], r["doc_id"]
    assert {r["doc_id"] for r in got if r["kept"]} == {r for r, (_, c) in want.items() if r == c}


def test_repeated_rows_are_copies(docs):  # noqa: F811
    text = " ".join(f"w{i}" for i in range(30))
    got = near_documents(docs([(4, text), (4, text), (9, text)])).collect()
    assert sorted((r["doc_id"], r["n_links"], r["class_id"], r["kept"]) for r in got) == [
        (4, 2, 4, True), (4, 2, 4, True), (9, 2, 4, False)]


def test_one_of_each_group_stays(docs):  # noqa: F811
    rows = docs(corpus(), extra=True)
    left = without_near_copies(rows)
    assert left.schema == rows.schema
    want = {r for r, _, c in brute(corpus()) if r == c}
    assert {r["doc_id"] for r in left.collect()} == want
    assert without_near_copies(docs([])).collect() == [] and near_documents(docs([])).collect() == []


def test_prefixes_are_shortened_to_the_recall():
    for recall in (0.9, 0.999, 0.9999):
        d = shared_depth(20, 12, 0.8, recall)
        assert 1 - (1 - 0.8**d) ** 20 >= recall > 1 - (1 - 0.8 ** (d + 1)) ** 20


def test_common_shingles(monkeypatch):
    monkeypatch.setattr(jaccard, "COLUMNS", 5)
    rng = np.random.default_rng(0)
    some = [np.unique(rng.integers(0, 60, n).astype(np.uint64)) for n in (30, 1, 50, 20, 40)]
    want = [[len(np.intersect1d(a, b)) for b in some] for a in some]
    got = common_shingles(some)
    for i in range(5):
        for j in range(5):
            assert i == j or got[i, j] == want[i][j]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(3, 250), (900, 901), (5, 5)]
    random.Random(1).shuffle(links)
    got = components(spark.createDataFrame(links, "a long, b long").repartition(4))
    told = {r["node"]: r["component"] for r in got.collect()}
    assert len(told) == got.count() == 61 + 60 + 2 + 2
    assert all(told[i] == 100 for i in range(100, 161)) and all(told[i] == 3 for i in [3, 7, *range(200, 260)])
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_no_text_is_lost_to_another_row_of_its_id(docs, monkeypatch, broadcast):  # noqa: F811
    monkeypatch.setattr(common, "BROADCAST_IDS", broadcast)
    w, u = (" ".join(f"{x}{i}" for i in range(30)) for x in "wu")
    rows = [(1, w), (2, w), (2, u), (4, u + " x"), (5, "alone here"), (5, "alone here"), (6, ""), (6, ""), (None, w), (0, w + " y")]
    left = [(r["doc_id"], r["text"]) for r in without_near_copies(docs(rows, extra=True)).collect()]
    assert sorted(left, key=repr) == sorted(
        [(0, w + " y"), (4, u + " x"), (5, "alone here"), (6, ""), (6, ""), (None, w)], key=repr)
