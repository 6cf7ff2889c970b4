"""Operator 6, language identification with string kernels.

A text is the set of its character n-grams for n from 1 to 3 (a blended
spectrum, by presence), hashed into one bit vector per n. The kernel of two
texts is the mean over n of the cosines of these sets. Nyström landmarks turn it
into features, and one ridge regression per language (one against the rest)
gives the scores, which for a batch of texts are two matrix products. The model
is fitted on a bounded sample; scoring is one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import carrying, held_out, mapped, text_of
from carelens.llm.sampling import labelled_ids, sample_texts

#: Labelled rows of each language to fit on, and how many of them are landmarks.
SAMPLE_PER_LANG = 500
LANDMARKS_PER_LANG = 30
#: Bits of the hashed sets of single characters, pairs and triples.
BITS = (9, 12, 14)
RIDGE = 1e-2
#: Texts scored by one matrix product; characters hashed at once.
ROWS, CHARS = 128, 1 << 18
UNKNOWN = "und"


def presence(text: str, out: np.ndarray) -> None:
    """Sets the bits of the n-grams in the lower-cased text, whole, piece by piece."""
    text = text.lower()
    for start in range(0, len(text), CHARS):
        piece = text[start : start + CHARS + len(BITS) - 1]  # n-grams over the border count
        code = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        base, mix = 0, np.zeros(len(code), dtype=np.uint32)
        for n, bits in enumerate(BITS):
            size = len(code) - n
            if size <= 0:
                break
            mix = (mix[:size] + code[n:]) * np.uint32(0x9E3779B1)
            mix ^= mix >> np.uint32(15)
            out[base + (mix * np.uint32(0x85EBCA6B) >> np.uint32(32 - bits))] = 1
            base += 1 << bits


WIDTH = sum(1 << b for b in BITS)


def vectors(texts: list[str]) -> np.ndarray:
    """One row per text, scaled so that a dot product is the kernel."""
    x = np.zeros((len(texts), WIDTH), dtype=np.float32)
    for row, text in zip(x, texts, strict=True):
        presence(text, row)
    return scaled(x)


def scaled(x: np.ndarray) -> np.ndarray:
    base = 0
    for bits in BITS:
        block = x[:, base : base + (1 << bits)]
        block /= np.sqrt(np.maximum(block.sum(axis=1, keepdims=True), 1) * len(BITS))
        base += 1 << bits
    return x


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass
class Kernel:
    langs: list[str]
    landmarks: np.ndarray
    weights: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.landmarks.T) @ self.weights


def fit_kernel(x: np.ndarray, lang: np.ndarray, ridge: float = RIDGE) -> Kernel:
    """Ridge regressions on Nyström features; the landmarks are the first rows of
    each language. Every language weighs the same in sum."""
    langs = sorted(set(lang))
    chosen = np.concatenate([np.flatnonzero(lang == g)[:LANDMARKS_PER_LANG] for g in langs])
    landmarks = x[chosen]
    values, basis = np.linalg.eigh((landmarks @ landmarks.T).astype(float))
    keep = values > values.max() * 1e-6
    root = basis[:, keep] / np.sqrt(values[keep])
    z = (x @ landmarks.T).astype(float) @ root
    size = np.array([np.count_nonzero(lang == g) for g in langs])
    weight = 1.0 / size[np.searchsorted(langs, lang)]
    y = np.where(lang[:, None] == np.array(langs)[None, :], 1.0, -1.0)
    solved = np.linalg.solve(z.T @ (z * weight[:, None]) + ridge * np.eye(z.shape[1]), z.T @ (y * weight[:, None]))
    return Kernel(langs, landmarks.astype(np.float32), (root @ solved).astype(np.float32))


def fit(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> Kernel | None:
    """A model of at most ``per_lang`` rows of each language whose lang is not null
    and which are not held out; None if there are none. Tasks send bit vectors, so
    a text's length doesn't matter to the driver."""
    rows = docs.where(~held_out() & F.col("lang").isNotNull())
    ids = labelled_ids(rows.select("doc_id", "lang"), "lang", per_lang)
    told = sample_texts(rows, ids.select("doc_id").distinct(), "lang").select(
        "doc_id", "lang", text_of("text").alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[batch["text"].map(has_letter).astype(bool)]
            packs = []
            for text in batch["text"]:
                bits = np.zeros(WIDTH, dtype=np.uint8)
                presence(text, bits)
                packs.append(np.packbits(bits).tobytes())
            yield pd.DataFrame({"key": batch["doc_id"].astype(str), "lang": batch["lang"], "bits": packs})

    rows = told.mapInPandas(run, "key string, lang string, bits binary").toPandas()
    if not len(rows):
        return None
    rows = rows.sort_values(["key", "lang"])
    bits = np.stack([np.unpackbits(np.frombuffer(b, dtype=np.uint8)) for b in rows["bits"]])
    return fit_kernel(scaled(bits.astype(np.float32)), rows["lang"].to_numpy(dtype=str))


def identify(docs: DataFrame, model: Kernel | None, text: str = "text") -> DataFrame:
    """``row`` (the input row without its text), lang_pred and score of every text.

    The score is the predicted language's share after a softmax of the regression
    values. Null texts, texts without a letter, and every text if there is no model
    are "und" with score 0. Ties go to the first language by name."""
    parts = (model.langs, model.landmarks, model.weights) if model else None
    shared = docs.sparkSession.sparkContext.broadcast(parts)  # a bounded number of landmarks per language

    def make():
        kernel = Kernel(*shared.value) if shared.value else None

        def run(texts: list[str]):
            lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if has_letter(t)] if kernel else []
            for start in range(0, len(known), ROWS):
                at = known[start : start + ROWS]
                found = 4.0 * kernel.scores(vectors([texts[i] for i in at])).astype(float)
                share = np.exp(found - found.max(axis=1, keepdims=True))
                share /= share.sum(axis=1, keepdims=True)
                best = share.argmax(axis=1)
                score[at] = share[np.arange(len(at)), best]
                for i, b in zip(at, best, strict=True):
                    lang[i] = kernel.langs[b]
            return lang, score

        return run

    rows = carrying(docs, [c for c in docs.columns if c != text], text)
    return mapped(rows, make, {"lang_pred": "string", "score": "double"})


def language_digest(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred and score."""
    told = identify(docs.select("doc_id", "text"), fit(docs.select("doc_id", "text", "lang")))
    return told.select("row.doc_id", held_out("row.doc_id").alias("held_out"), "lang_pred", "score")
