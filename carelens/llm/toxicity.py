"""Operator 10, toxicity with a convolutional text classifier.

A word is the sum of hashed embeddings of itself and of its first letters.
Filters over one, two and three neighbouring words are max-pooled over the whole
text and feed one output. Embeddings start from class log-odds, counted over all
labelled rows, and everything is trained together in numpy, by all labelled rows in
blocks, whose networks are averaged. The same hashed features tell the
language, and for each language the score is shifted so that the threshold that
is best for it is the one threshold of all. Thresholds come from margins of all labelled
rows by networks that haven't seen them: the rows are cut into folds, and each block
trains the networks of all folds. Scoring is one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import carrying, chosen, give_back, held_out, mapped, stored, text_of

#: Labelled rows that one network is trained on in a task, about; the networks of all
#: such blocks become one. A block ends at twice as many rows, or at ``BLOCK_BYTES``.
BLOCK_ROWS, BLOCK_BYTES = 4000, 200_000_000
#: Buckets of the hashed embeddings, their size, filter widths, filters of each.
BUCKETS, DIM, WIDTHS, FILTERS = 1 << 16, 8, (1, 2, 3), 6
#: First letters that a word is also known by.
PREFIXES = (4, 5, 6)
THRESHOLD = 0.3
#: Folds of the labelled rows for thresholds, and the texts of either label for which a
#: language's own threshold counts as much as that of all.
FOLDS, PRIOR = 5, 20
#: Distinct windows of words that ``pack`` keeps of a text at most; ``fit`` learns from all.
WINDOWS = 4096
#: Weights' changes are added up, and margins counted, as whole multiples of these shares of 1,
#: so that sums don't depend on the order of tasks. Margins are counted between plus and minus ``FAR``.
FINE, STEP, FAR = 1 << 36, 1 << 10, 64
EPOCHS, BATCH, RATE = 4, 32, 0.02
#: Words of a text that are convolved at once at most, and of texts together.
WORDS, TOGETHER = 100_000, 8_000
#: Texts whose words are told apart together; more would save time, but workers keep the memory.
TEXTS = 500
EDGE = re.compile(r"^[\W_]+|[\W_]+$")
SIGNS = "".join(c for c in map(chr, range(128)) if not c.isalnum())


def features(word: str) -> list[int]:
    """Buckets from 1 of a word and of its beginnings; bucket 0 is no word."""
    if not (word and word[0].isalnum() and word[-1].isalnum()):
        word = EDGE.sub("", word)
    if not word:
        return [0] * (1 + len(PREFIXES))
    parts = [word] + [f"{word[:n]}*" if len(word) >= n else "" for n in PREFIXES]
    return [1 + xxhash.xxh64_intdigest(p) % (BUCKETS - 1) if p else 0 for p in parts]


def hashes(parts: pa.Array) -> np.ndarray:
    """``xxhash.xxh64_intdigest`` of each string, step by step for all strings of under 32 bytes."""
    one, two, three, four, five = (np.uint64(p) for p in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

    def turned(x: np.ndarray, by: int) -> np.ndarray:
        return x << np.uint64(by) | x >> np.uint64(64 - by)

    parts = parts.cast(pa.large_binary())
    ends = np.frombuffer(parts.buffers()[1], dtype=np.int64)[parts.offset : parts.offset + len(parts) + 1]
    start, size = ends[:-1], np.diff(ends)
    data = np.concatenate([np.frombuffer(parts.buffers()[2] or b"", dtype=np.uint8), np.zeros(8, dtype=np.uint8)])
    eights, fours = (np.ndarray((len(data) - 7,), kind, data, strides=(1,)) for kind in ("<u8", "<u4"))
    out = size.astype(np.uint64) + five
    for k in range(3):
        at = np.flatnonzero(size >= 8 * k + 8)
        out[at] ^= turned(eights[start[at] + 8 * k] * two, 31) * one
        out[at] = turned(out[at], 27) * one + four
    at = np.flatnonzero(size & 4)
    out[at] ^= fours[start[at] + (size[at] & ~7)].astype(np.uint64) * one
    out[at] = turned(out[at], 23) * two + three
    for k in range(3):
        at = np.flatnonzero(size & 3 > k)
        out[at] ^= data[start[at] + (size[at] & ~3) + k].astype(np.uint64) * five
        out[at] = turned(out[at], 11) * one
    for by, factor in ((33, two), (29, three)):
        out ^= out >> np.uint64(by)
        out *= factor
    out ^= out >> np.uint64(32)
    for k in np.flatnonzero(size >= 32).tolist():
        out[k] = xxhash.xxh64_intdigest(parts[k].as_py())
    return out


def features_of(words: pa.Array) -> np.ndarray:
    """``features`` of each word as a row."""
    bare = pc.utf8_trim(words, characters=SIGNS)
    # other edges than ASCII are left to ``EDGE``
    other = pc.match_substring_regex(bare, r"^[^\x00-\x7f]|[^\x00-\x7f]$")
    some = [EDGE.sub("", w) for w in bare.filter(other).to_pylist()]
    if some:
        bare = pc.replace_with_mask(bare, other, pa.array(some, bare.type))
    size = pc.utf8_length(bare).to_numpy(zero_copy_only=False)
    out = np.zeros((len(bare), 1 + len(PREFIXES)), dtype=np.int32)
    for k, least in enumerate((1, *PREFIXES)):
        at = np.flatnonzero(size >= least)
        part = bare.take(pa.array(at))
        if k:
            star, nothing = (pa.scalar(x, part.type) for x in ("*", ""))
            part = pc.binary_join_element_wise(pc.utf8_slice_codeunits(part, 0, least), star, nothing)
        out[at, k] = 1 + hashes(part) % np.uint64(BUCKETS - 1)
    return out


def added(values: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each row of buckets the sum of their values."""
    found = values.take(ids[:, 0], axis=0)
    for column in ids.T[1:]:
        found += values.take(column, axis=0)
    return found


@dataclass
class Convolution:
    table: np.ndarray  # BUCKETS x DIM
    filters: list[np.ndarray]  # for each width: width x DIM x FILTERS
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    langs: list[str] = field(default_factory=list)
    odds: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, 0), dtype=np.float32))
    shift: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def projected(self, ids: np.ndarray) -> np.ndarray:
        """For each word, a row of feature buckets: what it adds to the filters at
        each offset, and its evidence for each language."""
        known = added(self.table, ids)
        flat = np.concatenate([f.transpose(1, 0, 2).reshape(DIM, -1) for f in self.filters], axis=1)
        return np.concatenate([known @ flat, added(self.odds, ids)], axis=1).astype(np.float32)

    def margins(self, rows: np.ndarray, words: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The output for each text: ``words`` are rows of ``rows`` for all texts one
        after the other, ``ends`` where each text ends."""
        n_maps = len(WIDTHS) * FILTERS
        n_proj = sum(WIDTHS) * FILTERS
        most = np.full((len(ends), n_maps), -np.inf, dtype=np.float32)
        evidence = np.zeros((len(ends), len(self.langs)))
        starts = np.concatenate([[0], ends[:-1]])
        for start, end in chunks(starts, ends):
            # pieces of texts within this stretch, each with the words just after it in its own text
            first, last = np.searchsorted(ends, start, side="right"), np.searchsorted(starts, end, side="left")
            which = np.arange(first, last)
            which = which[ends[which] > starts[which]]
            if not len(which):
                continue
            reach = min(end + max(WIDTHS) - 1, int(ends[which[-1]]))
            got = rows[words[start:reach]]
            left = ends[np.repeat(which, np.minimum(ends[which], reach) - np.maximum(starts[which], start))] - np.arange(start, reach)
            size = end - start
            cut = np.maximum(starts[which], start) - start
            at = 0
            for k, width in enumerate(WIDTHS):
                value = got[:size, at : at + FILTERS].copy()
                for j in range(1, width):
                    part = got[j : j + size, at + j * FILTERS : at + (j + 1) * FILTERS]
                    value[: len(part)] += np.where(left[: len(part), None] > j, part, 0)  # not from the next text
                at += width * FILTERS
                own = slice(k * FILTERS, (k + 1) * FILTERS)
                most[which, own] = np.maximum(most[which, own], np.maximum.reduceat(value, cut, axis=0))
            if self.langs:
                evidence[which] += np.add.reduceat(got[:size, n_proj:], cut, axis=0)
        pooled = np.where(np.isfinite(most), np.maximum(most + self.bias, 0), 0)
        margin = pooled @ self.out + self.out_bias
        return margin + self.shift[evidence.argmax(axis=1)] if self.langs else margin


def state_of(net: Convolution) -> tuple:
    """What ``Convolution`` is made from, to send between machines."""
    return net.table, net.filters, net.bias, net.out, net.out_bias, net.langs, net.odds, net.shift


def chunks(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of whole texts of ``TOGETHER`` words at most, which stay in the processor's
    cache, or of one longer text, of ``WORDS`` at most."""
    total, at = int(ends[-1]) if len(ends) else 0, 0
    while at < total:
        first, after = np.searchsorted(ends, [at, at + min(TOGETHER, WORDS)], side="right")
        end = int(ends[after - 1]) if after > first else min(at + WORDS, int(ends[first]))
        yield at, end
        at = end


def words_of(text: str) -> list[str]:
    return text.lower().split()


def split(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``words_of`` all texts: the buckets of each distinct word, the number of each word among
    them, one text after the other, and where each text ends. Arrow cuts and numbers the words."""
    lists = pc.utf8_split_whitespace(pa.array([t.lower() for t in texts], pa.large_string()))
    found = lists.flatten().dictionary_encode()
    code = found.indices.to_numpy()
    ends = lists.offsets.to_numpy()[1:].astype(np.int64) - lists.offsets[0].as_py()
    at = pc.index(found.dictionary, "").as_py()
    if at >= 0:  # white space at either end of a text is no word
        kept = code != at
        ends, code = np.concatenate([[0], np.cumsum(kept)])[ends], code[kept]
    return features_of(found.dictionary), code, ends


def in_parts(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text the buckets of distinct words, its own and maybe others, and its words' numbers among them."""
    for k in range(0, len(texts), TEXTS):
        buckets, code, ends = split(texts[k : k + TEXTS])
        for start, end in zip([0, *ends.tolist()], ends.tolist(), strict=False):
            yield buckets, code[start:end]
    pa.default_memory_pool().release_unused()


#: A text to learn from: a row of feature buckets and a count for each distinct word,
#: and a row of word numbers for each distinct window, the number of words for no word.
Windows = tuple[np.ndarray, np.ndarray]


def windows_of(text: str) -> Windows:
    """The whole text as ``Windows``: pooling sees each window of neighbouring words once only."""
    return next(all_windows([text]))


def all_windows(texts: list[str]) -> Iterator[Windows]:
    """``windows_of`` each text."""
    return (windows_in(*part) for part in in_parts(texts))


def windows_in(buckets: np.ndarray, words: np.ndarray) -> Windows:
    own, first, place = np.unique(words, return_index=True, return_inverse=True)
    n = len(own)
    order = np.argsort(first)  # words are numbered as they come
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.arange(n)
    at = np.concatenate([rank[place], np.full(max(WIDTHS) - 1, n)])
    windows = np.stack([at[j : j + len(words)] for j in range(max(WIDTHS))], axis=1)
    if (n + 1) ** max(WIDTHS) < 1 << 62:
        power = (n + 1) ** np.arange(max(WIDTHS))[::-1]
        windows = np.unique(windows @ power)[:, None] // power % (n + 1)
    else:
        windows = np.unique(windows, axis=0)
    windows = windows.astype(np.uint16 if n < 1 << 16 else np.int64)  # blocks hold those of thousands of texts
    rows = np.zeros((n, 2 + len(PREFIXES)), dtype=np.int32)
    if n:
        rows[:, :-1] = buckets[own[order]]
        rows[:, -1] = np.bincount(at, minlength=n + 1)[:n]
    return rows, windows


def pack(text: str) -> bytes:
    """The text's ``Windows`` as bytes, of over ``WINDOWS`` windows those with the least hashes."""
    rows, windows = windows_of(text)
    if len(windows) > WINDOWS:
        mix = np.zeros(len(windows), dtype=np.uint64)
        for column in windows.T:
            mix = (mix ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            mix ^= mix >> np.uint64(29)
        windows = windows[np.argsort(mix, kind="stable")[:WINDOWS]]
    used = np.unique(windows[windows < len(rows)])
    place = np.searchsorted(used, windows).astype(np.uint16)  # three words a window: far below 2^16
    return np.int32(len(used)).tobytes() + rows[used].tobytes() + place.tobytes()


def unpacked(packed: bytes) -> Windows:
    n, width = int(np.frombuffer(packed, np.int32, 1)[0]), 2 + len(PREFIXES)
    rows = np.frombuffer(packed, np.int32, n * width, 4).reshape(n, width)
    return rows, np.frombuffer(packed, np.uint16, -1, 4 + 4 * n * width).reshape(-1, max(WIDTHS))


def untrained(seen: np.ndarray, rows: np.ndarray, by_lang: np.ndarray, langs: list[str], seed: int = 7) -> Convolution:
    """What training starts from: how many rows of either label there are, and how many of
    either label and of each of ``langs`` hold each bucket."""
    rng = np.random.default_rng(seed)
    total = np.maximum(rows, 1)
    prior = 2 * total / total.sum()  # two texts' worth of each bucket, so that an unseen one has odds of 1
    log_odds = np.log((seen[1] + prior[1]) / total[1]) - np.log((seen[0] + prior[0]) / total[0])
    table = rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32)
    table[:, 0] = np.clip(log_odds, -1, 6) / 4
    table[0] = 0
    filters = [rng.normal(0, 0.1, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for f in filters:
        f[0, 0, : FILTERS // 2] += 1.0  # half of the filters start on the log-odds
    out = rng.uniform(0.1, 0.4, len(WIDTHS) * FILTERS).astype(np.float32)
    odds = np.log((by_lang + 0.5) / (by_lang.sum(axis=1, keepdims=True) + 1)).T if langs else np.zeros((BUCKETS, 0))
    odds[0] = 0
    return Convolution(table, filters, np.zeros_like(out), out, -2.0, langs, np.ascontiguousarray(odds, dtype=np.float32), np.zeros(len(langs)))


def joined(texts: list[Windows]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buckets of all texts' words, their windows as numbers among these words (the
    number of words for no word), and where each text's windows start."""
    sizes = np.array([len(words) for words, _ in texts])
    first, n = np.cumsum(sizes) - sizes, int(sizes.sum())
    counts = np.array([len(w) for _, w in texts])
    windows = np.concatenate([w for _, w in texts]).astype(np.int64, copy=False)
    none = windows == np.repeat(sizes, counts)[:, None]
    windows = windows + np.repeat(first, counts)[:, None]
    windows[none] = n
    return np.concatenate([words for words, _ in texts])[:, :-1], windows, np.cumsum(counts) - counts


def train(start: Convolution, texts: list[Windows], y: np.ndarray, seed: int = 7) -> Convolution:
    """The network after ``EPOCHS`` passes over the texts, from ``start`` on."""
    rng = np.random.default_rng(seed)
    table, filters = start.table.copy(), [f.copy() for f in start.filters]
    bias, out, out_bias = start.bias.copy(), start.out.copy(), np.array([start.out_bias], dtype=np.float32)
    slots: dict[str, list[np.ndarray]] = {}

    def adam(name: str, value: np.ndarray, grad: np.ndarray, t: int, rows: np.ndarray | None = None) -> None:
        if name not in slots:
            slots[name] = [np.zeros_like(value), np.zeros_like(value)]
        m, v = slots[name]
        at = slice(None) if rows is None else rows
        m[at] = 0.9 * m[at] + 0.1 * grad
        v[at] = 0.99 * v[at] + 0.01 * grad * grad
        value[at] -= RATE * (m[at] / (1 - 0.9**t)) / (np.sqrt(v[at] / (1 - 0.99**t)) + 1e-8)

    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for begin in range(0, len(order), BATCH):
            step += 1
            some = order[begin : begin + BATCH]
            full = some[[len(texts[i][0]) > 0 for i in some]]
            pooled = np.zeros((len(some), len(bias)), dtype=np.float32)
            spoken = np.isin(some, full)
            if len(full):
                x, windows, starts = joined([texts[i] for i in full])
                x = np.concatenate([x, np.zeros((1, x.shape[1]), dtype=x.dtype)])  # the last row is no word
                known = added(table, x)
                known[-1] = 0
                of_text = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(windows))))
                asked = np.ascontiguousarray(windows.T)
                top, best = [], []
                for w, f in zip(WIDTHS, filters, strict=True):
                    value = (known @ f[0]).take(asked[0], axis=0)
                    for j in range(1, w):
                        value += (known @ f[j]).take(asked[j], axis=0)
                    top.append(np.maximum.reduceat(value, starts, axis=0))
                    # the first window of each text that has its highest value: assigned last
                    at, own = np.divmod(np.flatnonzero(value == top[-1].take(of_text, axis=0))[::-1], FILTERS)
                    best.append(np.repeat(starts[:, None], FILTERS, axis=1))
                    best[-1][of_text[at], own] = at
                pooled[spoken] = np.maximum(np.concatenate(top, axis=1) + bias, 0)
            p = 1 / (1 + np.exp(-np.clip(pooled @ out + out_bias[0], -30, 30)))
            d = ((p - y[some]) / BATCH).astype(np.float32)
            back = (d[:, None] * out * (pooled > 0))[spoken]
            touched: list[np.ndarray] = []
            changes, grads = [], [np.zeros_like(f) for f in filters]
            if len(full):
                for k, w in enumerate(WIDTHS):
                    own = back[:, k * FILTERS : (k + 1) * FILTERS]
                    for j in range(w):
                        at = windows[best[k], j]
                        grads[k][j] = np.einsum("tq,tqd->dq", own, known[at])
                        hit = (own != 0) & (at < len(x) - 1)
                        touched.append(x[at[hit]])
                        changes.append((own[:, :, None] * filters[k][j].T)[hit])
            for k, g in enumerate(grads):
                adam(f"filter{k}", filters[k], g, step)
            adam("bias", bias, back.sum(axis=0), step)
            adam("out", out, d @ pooled + 1e-4 * out, step)
            np.maximum(out, 0, out=out)  # a pooled word speaks for toxicity; clean words beside it don't speak against
            adam("out_bias", out_bias, d.sum(keepdims=True), step)
            if sum(map(len, touched)):
                rows, place = np.unique(np.concatenate(touched), return_inverse=True)
                g = np.zeros((len(rows), DIM), dtype=np.float32)
                np.add.at(g, place.ravel(), np.repeat(np.concatenate(changes), x.shape[1], axis=0))
                g[rows == 0] = 0
                adam("table", table, g, step, rows)
    return Convolution(table, filters, bias, out, float(out_bias[0]), start.langs, start.odds, start.shift)


def small_weights(net: Convolution) -> np.ndarray:
    """All weights but the table's, in rows as long as the table's."""
    flat = np.concatenate([*[f.ravel() for f in net.filters], net.bias, net.out, [net.out_bias]]).astype(np.float64)
    return np.pad(flat, (0, -len(flat) % DIM)).reshape(-1, DIM)


def moved(start: Convolution, rows: np.ndarray, by: np.ndarray) -> Convolution:
    """``start`` with changes added: of the table at rows from 0, of the small weights below."""
    table, small = start.table.copy(), small_weights(start)
    table[rows[rows >= 0]] += by[rows >= 0]
    small[-1 - rows[rows < 0]] += by[rows < 0]
    flat, at, filters, n = small.ravel(), 0, [], len(start.bias)
    for f in start.filters:
        filters.append(flat[at : at + f.size].reshape(f.shape).copy())
        at += f.size
    return Convolution(table, filters, flat[at : at + n].copy(), flat[at + n : at + 2 * n].copy(), float(flat[at + 2 * n]),
                       start.langs, start.odds, start.shift)


def window_margin(net: Convolution, text: Windows) -> tuple[float, int]:
    """What ``margins`` gives for the text before languages' shifts, and the number of
    the language it is told to be in."""
    words, windows = text
    if not len(words):
        return net.out_bias, 0
    known = added(net.table, words[:, :-1])
    known = np.concatenate([known, np.zeros((1, DIM), dtype=known.dtype)])
    top = np.concatenate([
        sum((known @ f[j]).take(windows[:, j], axis=0) for j in range(len(f))).max(axis=0) for f in net.filters])
    evidence = words[:, -1] @ added(net.odds, words[:, :-1])
    return float(np.maximum(top + net.bias, 0) @ net.out + net.out_bias), int(evidence.argmax()) if len(evidence) else 0


def best_threshold(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The margin with the best F1 for label 1, midway to the next lower one."""
    order = np.argsort(-margin, kind="stable")
    hit = np.cumsum((y * weight)[order])
    f1 = 2 * hit / (np.cumsum(weight[order]) + (y * weight).sum())
    f1[:-1][margin[order][1:] == margin[order][:-1]] = -1  # equal margins fall on one side
    at = int(np.argmax(f1))
    below = margin[order[at + 1]] if at + 1 < len(order) else margin[order[at]] - 1
    return float((margin[order[at]] + below) / 2)


def shifts(margin: np.ndarray, told: np.ndarray, y: np.ndarray, weight: np.ndarray, langs: int) -> np.ndarray:
    """For each language what moves its best threshold to ``THRESHOLD``. A language's
    own threshold weighs as many texts as it has of the rarer label, that of all
    ``PRIOR`` texts, so languages with few texts keep near the threshold of all."""
    at = np.log(THRESHOLD / (1 - THRESHOLD))
    overall = best_threshold(margin, y, weight)
    out = np.full(max(langs, 1), at - overall)
    for k in range(langs):
        own = told == k
        n = min((y * weight)[own].sum(), ((1 - y) * weight)[own].sum())
        if n:
            out[k] = at - (n * best_threshold(margin[own], y[own], weight[own]) + PRIOR * overall) / (n + PRIOR)
    return out


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, lang, y and fold of every row that is learned from: those with a label
    that are not held out. Labels that repeat an id count once, documents each. Texts meet
    the labels in one shuffle at every size, so what is written grows with the input; texts are not sorted."""
    y = (F.col("toxic") > 0).cast("int").alias("y")
    ids = labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).select("doc_id", y).distinct()
    lang = text_of("lang") if "lang" in docs.columns else F.lit("")
    texts = docs.where(~held_out()).select("doc_id", text_of("text").alias("text"), lang.alias("lang"))
    fold = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(FOLDS)).cast("int").alias("fold")
    return texts.join(ids.hint("shuffle_hash"), "doc_id").select("doc_id", "text", "lang", "y", fold)


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``labelled_rows``, written once for all passes of the fit."""
    return stored(labelled_rows(docs, labels), "labelled")


def counted(rows: DataFrame, langs: list[str]) -> pd.DataFrame:
    """For each slot the number of its rows, as bucket -1, and of those that hold each
    bucket. Label y of a fold is slot 2 * fold + y, the languages follow, over all folds.
    Tasks count first, so what is left is bounded by slots and buckets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        give_back()
        found: dict[int, np.ndarray] = {}
        place = {lang: 2 * FOLDS + k for k, lang in enumerate(langs)}
        for batch in batches:
            parts = in_parts(batch["text"].tolist())
            for (buckets, words), lang, y, fold in zip(parts, batch["lang"], batch["y"], batch["fold"], strict=True):
                own = np.unique(buckets[words])
                for slot in [2 * fold + y, *([place[lang]] if lang else [])]:
                    if slot not in found:
                        found[slot] = np.zeros(BUCKETS + 1, dtype=np.int64)
                    n = found[slot]
                    n[own] += 1
                    n[BUCKETS] += 1
        for slot, n in found.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"slot": slot, "bucket": np.where(at == BUCKETS, -1, at), "n": n[at]})

    made = rows.select("text", "lang", "y", "fold").mapInPandas(run, "slot int, bucket int, n bigint")
    return made.groupBy("slot", "bucket").agg(F.sum("n").alias("n")).toArrow().to_pandas()


def starts_of(counts: pd.DataFrame, langs: list[str]) -> list[Convolution]:
    """The untrained networks without the rows of each fold, and last the one of all rows."""
    n = np.zeros((2 * FOLDS + len(langs), BUCKETS + 1))
    n[counts["slot"], counts["bucket"]] = counts["n"]  # the last column has the numbers of rows
    of_label, by_lang = n[: 2 * FOLDS].reshape(FOLDS, 2, -1), n[2 * FOLDS :, :-1]
    made = []
    for k in range(FOLDS + 1):
        own = of_label[np.arange(FOLDS) != k].sum(axis=0)
        made.append(untrained(own[:, :-1], own[:, -1], by_lang, langs))
        made[-1].odds = made[0].odds  # one for all
    return made


def trained(rows: DataFrame, starts: list[Convolution]) -> list[Convolution]:
    """The networks after all rows but their fold's. Rows are dealt to blocks by id and
    text; each block trains every network from its start, and the changes
    of a weight are averaged over the blocks that changed it."""
    shared = rows.sparkSession.sparkContext.broadcast([state_of(n) for n in starts])
    parts = max(1, -(-rows.count() // BLOCK_ROWS))
    places = [f"d{i}" for i in range(DIM)]

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        give_back()
        nets = [Convolution(*s) for s in shared.value]
        texts: list[Windows] = []
        labels: list[int] = []
        folds: list[int] = []
        size = 0

        def block() -> Iterator[pd.DataFrame]:
            give_back()  # what making the windows took
            y, fold = np.array(labels, dtype=float), np.array(folds)
            for k, start in enumerate(nets):
                own = np.flatnonzero(fold != k)
                if not len(own):
                    continue
                net = train(start, [texts[i] for i in own], y[own])
                changed = np.flatnonzero((net.table != start.table).any(axis=1))
                small = small_weights(net) - small_weights(start)
                by = np.rint(np.concatenate([net.table[changed] - start.table[changed], small]) * FINE).astype(np.int64)
                at = np.concatenate([changed, -1 - np.arange(len(small))])
                yield pd.DataFrame({"net": k, "at": at, **{p: by[:, i] for i, p in enumerate(places)}})

        for batch in batches:
            for text, y, fold in zip(all_windows(batch["text"].tolist()), batch["y"], batch["fold"], strict=True):
                texts.append(text)
                labels.append(y)
                folds.append(fold)
                size += text[0].nbytes + 8 * text[1].size
                if len(texts) >= 2 * BLOCK_ROWS or size >= BLOCK_BYTES:
                    yield from block()
                    texts, labels, folds, size = [], [], [], 0
        batch = None  # its texts aren't needed any more
        if texts:
            yield from block()

    h = F.xxhash64("text").alias("h")
    dealt = rows.select("*", h).repartition(parts, "doc_id", "h").sortWithinPartitions("h", "doc_id", "y", "lang")
    made = dealt.select("text", "y", "fold").mapInPandas(learn, ", ".join(["net int, at int", *[f"{p} bigint" for p in places]]))
    got = made.groupBy("net", "at").agg(F.count("*").alias("n"), *[F.sum(p).alias(p) for p in places]).toArrow().to_pandas()
    shared.destroy()
    nets = []
    for k, start in enumerate(starts):
        own = got[got["net"] == k]
        nets.append(moved(start, own["at"].to_numpy(), own[places].to_numpy() / FINE / own["n"].to_numpy()[:, None]))
    return nets


def margins_of(rows: DataFrame, nets: list[Convolution]) -> pd.DataFrame:
    """How many rows of each label have each margin (in whole steps) by the network that
    hasn't seen their fold, for the language that it tells."""
    shared = rows.sparkSession.sparkContext.broadcast([state_of(n) for n in nets])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        give_back()
        own = [Convolution(*s) for s in shared.value]
        found: Counter[tuple[int, int, int]] = Counter()
        for batch in batches:
            for text, y, fold in zip(all_windows(batch["text"].tolist()), batch["y"], batch["fold"], strict=True):
                margin, told = window_margin(own[fold], text)
                found[told, y, round(min(max(margin, -FAR), FAR) * STEP)] += 1
        yield pd.DataFrame([(*key, n) for key, n in found.items()], columns=["told", "y", "step", "n"]).astype("int64")

    made = rows.select("text", "y", "fold").mapInPandas(run, "told int, y int, step int, n bigint")
    got = made.groupBy("told", "y", "step").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    shared.destroy()
    return got.sort_values(["told", "step", "y"])


def fit(docs: DataFrame, labels: DataFrame) -> Convolution | None:
    """A model of every labelled row that is not held out, by its whole text. None if a
    label is missing. The start of each network is counted over all rows but its fold's;
    blocks of rows train ``FOLDS`` networks without one fold each, and one with all; the
    thresholds come from the margins of all rows by the network of their own fold (what
    tells languages apart is counted over all folds). What
    reaches the driver grows with buckets, languages and steps of the margin, not with rows.
    lang is read here only, to learn what tells languages apart."""
    rows = labelled(docs, labels)
    if rows.select("y").distinct().count() < 2:
        return None
    langs = sorted(r["lang"] for r in rows.where("lang != ''").select("lang").distinct().collect())
    *nets, model = trained(rows, starts_of(counted(rows, langs), langs))
    made = margins_of(rows, nets)
    columns = [made[c].to_numpy(dtype=float) for c in ("step", "y", "n")]
    model.shift = shifts(columns[0] / STEP, made["told"].to_numpy(), columns[1], columns[2], len(model.langs))
    if not model.langs:
        model.out_bias += float(model.shift[0])
    return model


def scorer(model: Convolution | None, docs: DataFrame):
    """A function for tasks that makes one from texts to scores; the model has a
    fixed number of buckets and is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(None if model is None else state_of(model))

    def make():
        net = Convolution(*shared.value) if shared.value else None
        def some(texts: list[str]) -> np.ndarray:
            buckets, code, ends = split(texts)
            return 1 / (1 + np.exp(-np.clip(net.margins(net.projected(buckets), code, ends), -30, 30)))

        def run(texts: list[str]) -> np.ndarray:
            if net is None:
                return np.zeros(len(texts))
            found = np.concatenate([some(texts[k : k + TEXTS]) for k in range(0, len(texts), TEXTS)])
            pa.default_memory_pool().release_unused()  # what runs next in this worker needs it
            return found

        return run

    return make


def score(docs: DataFrame, model: Convolution | None, text: str = "text") -> DataFrame:
    """``row`` (the input row without its text), score and predicted of every whole
    text.

    Null and empty texts score what a text without any word does. Without a model
    every score is 0. Equal texts get equal scores."""
    ready = scorer(model, docs)

    def make():
        run = ready()

        def told(texts: list[str]):
            found = run(texts)
            return found, (found >= THRESHOLD).astype(np.int32)

        return told

    rows = carrying(docs, [c for c in docs.columns if c != text], text)
    return mapped(rows, make, {"score": "double", "predicted": "int"})


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and maybe lang, and any other columns) that
    a model learned from its own labelled rows doesn't predict as toxic."""
    ready = scorer(fit(docs, labels), docs)

    def make():
        run = ready()
        return lambda texts: run(texts) < THRESHOLD

    return chosen(docs, "text", make)


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score and predicted."""
    told = score(docs.select("doc_id", "text"), fit(docs, labels))
    return told.select("row.doc_id", held_out("row.doc_id").alias("held_out"), "score", "predicted")
