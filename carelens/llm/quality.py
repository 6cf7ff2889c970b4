"""Operator 4, quality rules and gradient-boosted trees over document statistics.

Each task counts the statistics of its whole texts, flags what fails the base
rules, and scores the rest with trees that were fitted on a bounded sample and
flattened into numpy arrays. Nothing is shuffled but the sample's ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from carelens.llm.common import carrying, mapped, text_of
from carelens.llm.sampling import labelled_ids, sample_texts

#: Labelled rows of each label to fit on.
SAMPLE_PER_LABEL = 5000
#: Share of well labelled sample rows that the verdict may lose at most.
LOST = 0.002
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
WINDOW = 5

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Statistics the trees see, and whether quality may only fall (-1) with them.
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "symbols_per_word": -1,
    "duplicate_lines": -1,
    "repeated_words": -1,
    "capitals": -1,
    "marks_per_word": 0,
    "digits_per_word": 0,
    "words_per_line": 0,
    "distinct_words": 0,
}


def _repeats(words: list[bytes]) -> int:
    """Words covered by a window of five that stands twice or more in the text.
    Windows are compared by a 64-bit mix of their words' hashes."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    code = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    mix = np.zeros(n, dtype=np.uint64)
    for i in range(WINDOW):
        mix = (mix ^ code[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        mix ^= mix >> np.uint64(29)
    order = np.argsort(mix, kind="stable")
    same = mix[order][1:] == mix[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    covered[:n] += twice
    covered[WINDOW : WINDOW + n] -= twice
    return int((np.cumsum(covered) > 0).sum())


def statistics(text: str) -> tuple[list[int], list[float]]:
    """The counts of the base rules and the features of one whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    bins = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    chars = len(raw) - int(bins[0x80:0xC0].sum())
    word_chars = chars - int(bins[list(SPACES)].sum())
    symbols = int(bins[list(SYMBOLS)].sum())
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    repeated = _repeats(words)
    counts = [len(words), word_chars, symbols, len(lines) - len(set(lines)), repeated]
    n = max(len(words), 1)
    upper, lower = int(bins[65:91].sum()), int(bins[97:123].sum())
    marks = int(bins[33:48].sum() + bins[58:65].sum() + bins[91:97].sum() + bins[123:127].sum())
    features = [
        np.log1p(len(words)), word_chars / n, symbols / n, counts[3] / max(len(lines), 1), repeated / n,
        upper / max(upper + lower, 1), marks / n, int(bins[48:58].sum()) / n, len(words) / max(len(lines), 1),
        len(set(words)) / n]
    return counts, features


@dataclass
class Trees:
    """Boosted trees as arrays over all nodes: a row goes left where its feature is
    at most the threshold; a leaf points at itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int
    cut: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[row, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)


def fit_trees(
    x: np.ndarray, y: np.ndarray, monotone: list[int],
    rounds: int = 60, depth: int = 3, bins: int = 64, rate: float = 0.2, ridge: float = 1.0, least: float = 2.0,
) -> Trees:
    """Second-order boosting of the logistic loss on binned features.

    A split on a feature with constraint -1 (+1) is only made where the right
    child's value is not above (below) the left one's, and both children's
    subtrees stay on their side of the midpoint, so the score is monotonic in it.
    Rows of both labels weigh the same in sum."""
    grid = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    code = np.stack([np.searchsorted(g, x[:, f], side="left") for f, g in enumerate(grid)], axis=1)
    weight = np.where(y == 1, len(y) / (2 * max(y.sum(), 1)), len(y) / (2 * max((1 - y).sum(), 1)))
    nodes: list[list[float]] = []
    roots, margin = [], np.zeros(len(y))

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, low: float, high: float, level: int) -> int:
        at = len(nodes)
        own = float(np.clip(-g[rows].sum() / (h[rows].sum() + ridge), low, high))
        nodes.append([0, np.inf, at, at, rate * own])
        best = (1e-6, -1, -1, 0.0, 0.0)
        if level < depth:
            whole = g[rows].sum() ** 2 / (h[rows].sum() + ridge)
            for f, edges in enumerate(grid):
                if not len(edges):
                    continue
                size = len(edges) + 1
                gl = np.cumsum(np.bincount(code[rows, f], weights=g[rows], minlength=size))
                hl = np.cumsum(np.bincount(code[rows, f], weights=h[rows], minlength=size))
                gr, hr = (gl[-1] - gl)[:-1], (hl[-1] - hl)[:-1]
                gl, hl = gl[:-1], hl[:-1]
                wl = np.clip(-gl / (hl + ridge), low, high)
                wr = np.clip(-gr / (hr + ridge), low, high)
                gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - whole
                gain[(hl < least) | (hr < least) | (monotone[f] * (wr - wl) < 0)] = -np.inf
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), f, k, float(wl[k]), float(wr[k]))
        if best[1] >= 0:
            _, f, k, wl, wr = best
            mid, sign = (wl + wr) / 2, monotone[f]
            goes = code[rows, f] <= k
            lows, highs = ([low, mid], [mid, high]) if sign > 0 else ([mid, low], [high, mid])
            if not sign:
                lows, highs = [low, low], [high, high]
            nodes[at][:2] = [f, grid[f][k]]
            nodes[at][2] = grow(rows[goes], g, h, lows[0], highs[0], level + 1)
            nodes[at][3] = grow(rows[~goes], g, h, lows[1], highs[1], level + 1)
        return at

    def flat() -> Trees:
        table = np.array(nodes, dtype=float).reshape(-1, 5)
        return Trees(table[:, 0].astype(int), table[:, 1], table[:, 2].astype(int), table[:, 3].astype(int),
                     table[:, 4], np.array(roots, dtype=int), 0.0, depth)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        first = len(nodes)
        roots.append(grow(np.arange(len(y)), weight * (p - y), weight * p * (1 - p), -np.inf, np.inf, 0))
        tree = flat()
        tree.roots = np.array([first])
        margin += tree.margin(x)
    return flat()


def fit(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> Trees | None:
    """Trees fitted on at most ``per_label`` rows of each quality label, of which a
    fifth sets the cut: at 0.5, or lower if that would lose more than ``LOST`` of
    the well labelled. None if a label is missing; then the rules decide alone."""
    ids = labelled_ids(labels, "quality", per_label)
    told = sample_texts(docs, ids).select("quality", text_of("text").alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array([statistics(t)[1] for t in batch["text"]]).reshape(len(batch), -1)
            yield pd.DataFrame({"y": batch["quality"], "x": list(x)})

    rows = told.mapInPandas(run, "y int, x array<double>").toPandas()
    if rows["y"].nunique() < 2:
        return None
    rows = rows.assign(key=rows["x"].map(tuple)).sort_values(["key", "y"])  # whatever order tasks ended in
    x, y = np.stack(rows["x"].to_numpy()), (rows["y"].to_numpy() > 0).astype(float)
    aside = np.arange(len(y)) % 5 == 0
    trees = fit_trees(x[~aside], y[~aside], list(FEATURES.values()))
    good = np.sort(trees.margin(x[aside & (y == 1)]))
    if len(good):
        trees.cut = min(0.0, float(good[int(len(good) * LOST)]) - 1e-9)
    return trees


def judge(docs: DataFrame, trees: Trees | None, text: str = "text") -> DataFrame:
    """``row`` (the input row without its text), the counts, base_failed, score (the
    trees' probability of good quality) and kept.

    A text fails the base rules with fewer than ten words or with more than a
    fifth of its words in repeated windows of five; null and empty texts have no
    words and fail. Without trees, what passes is kept with score 1."""

    def make():
        def run(texts: list[str]):
            told = [statistics(t) for t in texts]
            counts = np.array([t[0] for t in told], dtype=np.int64)
            failed = (counts[:, 0] < 10) | (100 * counts[:, 4] > 20 * counts[:, 0])
            if trees is None:
                score, passed = np.ones(len(told)), np.ones(len(told), dtype=bool)
            else:
                margin = trees.margin(np.array([t[1] for t in told], dtype=float))
                score, passed = 1 / (1 + np.exp(-margin)), margin >= trees.cut
            return [*counts.T, failed, score, passed & ~failed]

        return run

    rows = carrying(docs, [c for c in docs.columns if c != text], text)
    return mapped(rows, make, dict.fromkeys(COUNTS, "bigint") | {
        "base_failed": "boolean", "score": "double", "kept": "boolean"})


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, the counts, base_failed, kept and score."""
    docs = docs.select("doc_id", "text")
    told = judge(docs, fit(docs, labels))
    return told.select("row.doc_id", *COUNTS, "base_failed", "kept", "score")
