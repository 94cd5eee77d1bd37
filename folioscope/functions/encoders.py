"""Encoders: model-based scores over any encoder, and deterministic stand-ins for embedding models.

An encoder of tokens gives a vector per token of a text, as the rows of an array; an
encoder of texts gives one vector. The stand-ins hash words, so they know equal words and nothing of their meaning.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope.functions.arrays import let

TokenEncoder = Callable[[str], np.ndarray]
TextEncoder = Callable[[str], np.ndarray]
#: Hypothesis tokens compared with the reference at once, which bounds the table of similarities.
BLOCK = 512


def word_vectors(text: str) -> np.ndarray:
    """Stand-in: one of 256 unit vectors per white-space token, by the first byte of the lower-cased token's MD5."""
    slots = [hashlib.md5(w.encode(), usedforsecurity=False).digest()[0] for w in text.lower().split()]
    return np.eye(256, dtype=np.float32)[slots] if slots else np.zeros((0, 256), np.float32)


def word_counts(text: str) -> np.ndarray:
    """Stand-in: the sum of the word vectors."""
    return word_vectors(text).sum(axis=0, dtype=np.float64)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


def bertscore_f1(encoder: TokenEncoder) -> Callable[[str, str], float]:
    """Scorer: every token's best cosine on the other side, averaged into precision and recall; 0 without tokens on a side."""

    def score(reference: str, hypothesis: str) -> float:
        r, h = _unit(encoder(reference)), _unit(encoder(hypothesis))
        if not len(r) or not len(h):
            return 0.0
        best_r, found = np.full(len(r), -1.0), 0.0
        for at in range(0, len(h), BLOCK):
            similar = h[at : at + BLOCK] @ r.T
            found += float(similar.max(axis=1).sum(dtype=np.float64))
            best_r = np.maximum(best_r, similar.max(axis=0))
        p, q = found / len(h), float(best_r.mean())
        return 2 * p * q / (p + q) if p + q > 0 else 0.0

    return score


def semantic_similarity(encoder: TextEncoder) -> Callable[[str, str], float]:
    """Scorer: cosine of the two texts' vectors; 0 if either has no length."""

    def score(reference: str, hypothesis: str) -> float:
        a, b = (np.asarray(encoder(t), dtype=np.float64) for t in (reference, hypothesis))
        length = float(np.linalg.norm(a) * np.linalg.norm(b))
        return float(a @ b) / length if length > 0 else 0.0

    return score


def scorers(tokens: TokenEncoder = word_vectors, texts: TextEncoder = word_counts) -> dict[str, Callable[[str, str], float]]:
    """The model-based metrics of score_answers, by default with the stand-ins."""
    return {"bertscore_f1": bertscore_f1(tokens), "semantic_similarity": semantic_similarity(texts)}


def hashed_words(text: Column, dimension: int = 64) -> Column:
    """Counts of hashed lower-case words, scaled to length 1; null for a text without words."""

    def of(slots: Column) -> Column:
        counts = F.transform(
            F.sequence(F.lit(0), F.lit(dimension - 1)), lambda i: F.size(F.filter(slots, lambda s: s == i)).cast("double")
        )
        return let(
            counts, lambda c: F.transform(c, lambda x: (x / F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, y: a + y * y))).cast("float"))
        )

    words = F.array_remove(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), "")
    slots = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(dimension)).cast("int"))
    return F.when(F.size(words) > 0, let(slots, of))
