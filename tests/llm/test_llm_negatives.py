import math
import random

import numpy as np
import pytest
from llm_fixtures import SMALL  # noqa: F401

from carelens.llm import negatives
from carelens.llm.negatives import Tree, hard_negatives, str_cuts, tile_of


def brute(rows, every=50):
    fine = {
        (i, (lab + 1) % 10 if i % 7 == 0 else lab, tuple(math.floor(256 * x) for x in v)) for i, lab, v in rows
        if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, lab, q in fine:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, r, strict=True)), j, m) for j, m, r in fine if j != i and len(r) == len(q))
        for s, j, _ in [x for x in scored if x[2] == lab][:5]:
            ok = [x for x in scored if x[2] != lab and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(i, j, k + 1, x[1], -s, -x[0]) for k, x in enumerate(ok)]
    return sorted(out)


def test_boxes_hold_all_scores_and_search_is_exact():
    rng = np.random.default_rng(1)
    rows = rng.integers(-90, 120, (900, 6))
    rows[300:600] = rows[300]  # equal vectors
    ids, labels = rng.permutation(900), rng.integers(0, 3, 900)
    tree = Tree(ids, labels, rows)
    anchors = rng.integers(-50, 50, (20, 6))
    low, high = tree.intervals(anchors)
    for k, a in enumerate(anchors):
        score = tree.rows @ a
        for box in range(len(tree.cut) - 1):
            part = score[tree.cut[box] : tree.cut[box + 1]]
            assert low[k][box] <= part.min() and part.max() <= high[k][box]
        windows = [(-(1 << 62), 1 << 62), (100, 900), (5, 4), (-2000, -100)]
        got = tree.search(a, low[k], high[k], lambda p: tree.labels[p] == 1, windows, 4)
        for (least, top), found in zip(windows, got, strict=True):
            want = sorted((-int(s), int(i)) for s, i, lab in zip(score, tree.ids, tree.labels, strict=True) if lab == 1 and least <= s <= top)
            assert found == want[:4]


def test_tiles_divide_all_rows_evenly():
    rows = np.random.default_rng(0).normal(0, 100, (5000, 8)).astype(int)
    sizes = np.bincount(tile_of(rows, str_cuts(rows, 40)))
    assert sizes.sum() == 5000 and len(sizes) >= 32 and sizes.max() <= 400


@pytest.mark.parametrize("small", [False, True])
def test_odd_rows(spark, monkeypatch, small):
    if small:  # many tiles and blocks
        for name, value in (("TILE", 40), ("ANCHORS", 3), ("LEAF", 8), ("FAN", 3), ("SAMPLE", 100)):
            monkeypatch.setattr(negatives, name, value)
    rng = random.Random(7)
    rows = [(i, rng.choice([0, 1, 2, 9]), [rng.gauss(0.4, 0.3) for _ in range(5)]) for i in range(300)]
    rows += [(1000 + i, i % 2, [0.5, 0.5, 0.5, 0.5, 0.5]) for i in range(150)]  # ties
    rows += [(50, 1, [0.1, 0.2]), (51, 1, [0.3, 0.4]), (52, 2, [0.2, 0.3]), (53, 2, [0.25, 0.2])]  # ids again, another length
    rows += [rows[0], rows[1], (None, 1, [1.0] * 5), (2000, None, [1.0] * 5), (2050, 1, None), (2100, 1, []), (2150, 3, [float("nan")] * 5),
             (2200, 3, [None, 1.0, 1.0, 1.0, 1.0]), (2250, 3, [float("inf")] * 5), (2300, 3, [0.0] * 5), (-50, 2, [0.3] * 5)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<double>, own string, q int").repartition(4)
    got = sorted(map(tuple, hard_negatives(df).collect()))
    assert got == brute(rows)


def test_no_rows(spark):
    df = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert hard_negatives(df).collect() == []
