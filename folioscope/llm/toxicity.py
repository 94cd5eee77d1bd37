"""Toxicity grades by cumulative-link ordinal regression on sparse text features (operator 10).

A document's features are its distinct lower-cased words and their prefixes,
hashed to `bits` bits; each is present or not. Features that toxic documents of
the sample don't show clearly more often are screened out, which keeps the
model sparse and long clean texts from adding up noise: twice the log likelihood
ratio of a feature must reach 2 ln(features / `chance`), so that among all features of
the sample fewer than `chance` are expected to get in by chance alone. The model has
one weight per feature, shared by all thresholds, and ordered thresholds
theta_1 < theta_2 < ...: P(grade > k) = sigmoid(score - theta_k). The expected
severity is the sum of these probabilities.

Grades: 0 for clean labels. Toxic labels are split in two by how many telling
features they have (features far likelier in toxic documents of the sample): 1
below the median, 2 from it on. So with a binary label the severity that is learned is
an amount of telling features, not a judgement anyone made; a label column with more
than two levels is used as it is.

Fitting sees at most `max_rows` labelled documents (smallest hash of doc_id): a
documented bound for the classifier only. All hashed features of their whole
texts come to the driver: four bytes each, at most four a distinct word and 2^bits a
text. Scoring reads every whole text of all documents.

Defined cases: a null or empty text scores the bias alone and is not toxic;
a document labelled several times takes the worst label; without both classes
in the labels, or with so few that no feature reaches the evidence, nothing is toxic (a
warning says so); repeated rows are each scored; all columns of the input
are passed through by `keep_clean`, others are ignored.
"""

from __future__ import annotations

import re
import uuid
import warnings
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.common import ship, trimmed

_WORD = re.compile(r"\w+")


def word_features(word: str, bits: int) -> list[int]:
    """Hashes of a word and its prefixes of 4, 5 and 6 characters."""
    import xxhash

    mask = (1 << bits) - 1
    names = {"w" + word, *("p" + word[:k] for k in (4, 5, 6) if len(word) >= k)}
    return [xxhash.xxh3_64_intdigest(x) & mask for x in sorted(names)]


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


@dataclass
class Ordinal:
    """Weights shared by all thresholds, and the thresholds in rising order."""

    weights: np.ndarray
    thetas: np.ndarray
    bits: int
    name: str = field(default_factory=lambda: uuid.uuid4().hex)  # goes with the model wherever it is sent

    def severity(self, score: np.ndarray) -> np.ndarray:
        z = np.clip(score[:, None] - self.thetas[None, :], -40, 40)
        return (1 / (1 + np.exp(-z))).sum(axis=1)


class Sparse:
    """Rows of features as coordinates: feature used[flat[k]] is in row doc[k]. 32-bit, as the driver's memory is small."""

    def __init__(self, rows: list[np.ndarray]) -> None:
        sizes = np.array([len(r) for r in rows], np.int64)
        flat = np.concatenate(rows).astype(np.int32) if sizes.sum() else np.zeros(0, np.int32)
        self.n = len(rows)
        self.used = np.unique(flat)
        self.flat = np.searchsorted(self.used, flat).astype(np.int32)
        self.doc = np.repeat(np.arange(self.n, dtype=np.int32), sizes)

    def sums(self, per_doc: np.ndarray) -> np.ndarray:
        """Per feature, the sum of a value of its rows."""
        out = np.zeros(len(self.used))
        step = 1 << 20  # pieces, so that no long temporary arises
        for a in range(0, len(self.flat), step):
            out += np.bincount(self.flat[a : a + step], weights=per_doc[self.doc[a : a + step]], minlength=len(self.used))
        return out


def fit_ordinal(table: Sparse, grades: np.ndarray, bits: int, epochs: int = 300, l2: float = 1e-3, chance: float = 0.005) -> Ordinal:
    """Gradient descent (Adam) on the likelihood of P(grade > k) = sigmoid(w.x - theta_k).

    Thresholds are theta_1 plus sums of exponentials, so they stay in order.
    Rare grades weigh as much as common ones.
    """
    evidence = 2 * np.log(max(len(table.used), 2) / chance)
    levels = int(grades.max()) if len(grades) else 0
    if levels == 0 or (grades == 0).all() or (grades > 0).all():
        return Ordinal(np.zeros(1 << bits, np.float32), np.full(1, 20.0), bits)
    used, n = table.used, table.n
    toxic = grades > 0
    # Near copies of a text count as one, else what only they share would pass for evidence.
    _, copy, copies = np.unique(_copies(table), return_inverse=True, return_counts=True)
    weight = 1 / copies[copy]
    hot, cold = table.sums(weight * toxic), table.sums(weight * ~toxic)
    base = (weight * toxic).sum() / weight.sum()
    # Twice the log likelihood ratio of the feature's own share of toxic texts against the general one.
    rate = hot / np.maximum(hot + cold, 1e-12)
    terms = [k * np.log(np.maximum(x, 1e-12) / y) for k, x, y in ((hot, rate, base), (cold, 1 - rate, 1 - base))]
    kept = np.flatnonzero((rate > 3 * base / (1 + 2 * base)) & (2 * (terms[0] + terms[1]) >= evidence))
    if not len(kept):
        warnings.warn("no feature tells toxic from clean labels clearly enough: nothing will be graded toxic", stacklevel=2)
        return Ordinal(np.zeros(1 << bits, np.float32), np.full(1, 20.0), bits)
    column = np.full(len(used), -1, np.int32)
    column[kept] = np.arange(len(kept))
    on = column[table.flat] >= 0
    doc, col = table.doc[on], column[table.flat[on]]
    share = np.bincount(grades, minlength=levels + 1)
    importance = (len(grades) / (levels + 1) / np.maximum(share, 1))[grades]
    w = np.zeros(len(kept))
    gaps = np.zeros(levels)  # theta_1, then log differences
    gaps[0] = 1.0
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(gaps), np.zeros_like(gaps)]
    above = (grades[:, None] > np.arange(levels)[None, :]).astype(float)
    for t in range(1, epochs + 1):
        thetas = gaps[0] + np.concatenate([[0.0], np.cumsum(np.exp(gaps[1:]))])
        score = np.bincount(doc, weights=w[col], minlength=n)
        p = 1 / (1 + np.exp(-np.clip(score[:, None] - thetas[None, :], -40, 40)))
        d = (p - above) * importance[:, None] / n
        g_w = np.bincount(col, weights=d.sum(axis=1)[doc], minlength=len(w)) + l2 / n * w
        g_theta = -d.sum(axis=0)
        g_gap = np.concatenate([[g_theta.sum()], np.exp(gaps[1:]) * np.cumsum(g_theta[::-1])[::-1][1:]])
        for x, g, a, b in ((w, g_w, 0, 1), (gaps, g_gap, 2, 3)):
            moments[a] = 0.9 * moments[a] + 0.1 * g
            moments[b] = 0.99 * moments[b] + 0.01 * g * g
            x -= 0.1 * (moments[a] / (1 - 0.9**t)) / (np.sqrt(moments[b] / (1 - 0.99**t)) + 1e-9)
        np.maximum(w, 0, out=w)  # what is kept speaks for toxicity, never against it
        gaps[0] = max(gaps[0], 0.5)  # a text without any telling feature scores 0 and stays clean
    weights = np.zeros(1 << bits, np.float32)
    weights[used[kept]] = w
    thetas = gaps[0] + np.concatenate([[0.0], np.cumsum(np.exp(gaps[1:]))])
    return Ordinal(weights, thetas, bits)


def _copies(table: Sparse, bands: int = 6, width: int = 3, least_features: int = 10) -> np.ndarray:
    """A number per row, equal for rows linked by agreeing in all least hashes of some band of their rarer features.

    Rows with very few of these are taken as they are.
    """
    n = table.n
    rare = np.bincount(table.flat, minlength=len(table.used))[table.flat] <= max(20, n // 20)
    rare &= np.bincount(table.doc[rare], minlength=n)[table.doc] >= least_features
    flat, starts = table.flat[rare], np.flatnonzero(np.diff(table.doc[rare], prepend=-1))
    owners = table.doc[rare][starts]
    none = np.iinfo(np.uint64).max
    up = list(range(n))

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for band in range(bands):
        least = np.full((width, n), none, np.uint64)
        for k in range(width):
            h = (table.used.astype(np.uint64) + np.uint64(1 + band * width + k)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(32)
            if len(starts):
                least[k][owners] = np.minimum.reduceat(h[flat], starts)
        first: dict[tuple, int] = {}
        for i, x in enumerate(map(tuple, least.T.tolist())):
            if x[0] != none:
                up[find(i)] = find(first.setdefault(x, i))
    return np.array([find(i) for i in range(n)])


def grade(table: Sparse, labels: np.ndarray) -> np.ndarray:
    """Ordered grades from labels; a binary label's positives are split by their number of telling features."""
    levels = np.unique(labels)
    if len(levels) != 2:
        return np.searchsorted(levels, labels)
    toxic = labels == levels[1]
    hot, cold = table.sums(toxic.astype(float)), table.sums((~toxic).astype(float))
    telling = (hot >= 5) & (hot / max(toxic.sum(), 1) > 20 * cold / max((~toxic).sum(), 1))
    n = np.bincount(table.doc[telling[table.flat]], minlength=table.n)
    return np.where(~toxic, 0, np.where(n < np.median(n[toxic]), 1, 2))


def _sampled(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    picked = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    # At most max_rows rows, so broadcasting them is bounded.
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 6000, bits: int = 20) -> Ordinal:
    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [np.unique(np.fromiter((h for w in words_of(text) for h in word_features(w, bits)), np.int32)) for text in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "y": b["y"], "f": [x.tobytes() for x in out]})

    ship(docs.sparkSession)
    found = (
        _sampled(docs, labels, max_rows)
        .dropDuplicates(["doc_id"])
        .mapInPandas(trimmed(hashed), "doc_id long, y int, f binary")
        .orderBy("doc_id")
        .collect()
    )
    labels_ = np.array([r["y"] for r in found], dtype=np.int64)
    table = Sparse([np.frombuffer(bytes(r["f"]), np.int32) for r in found])
    del found
    return fit_ordinal(table, grade(table, labels_), bits)


def score(docs: DataFrame, model: Ordinal, cache_words: int = 100_000) -> DataFrame:
    """(all columns of docs, _tx_severity, _tx_grade): expected severity and the likeliest side of each threshold."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(text: pd.Series) -> pd.DataFrame:
        m = shared.value
        nz = m.weights != 0
        values = []
        if m.name not in _CACHE:  # workers are used again; one model's words are kept at a time
            _CACHE.clear()
        known = _CACHE.setdefault(m.name, {})
        for t in text:
            seen: set[int] = set()
            for w in words_of(t):
                f = known.get(w)
                if f is None:
                    f = tuple(h for h in word_features(w, m.bits) if nz[h])
                    if len(known) >= cache_words:
                        known.clear()
                    known[w] = f
                seen.update(f)
            values.append(float(m.weights[np.fromiter(seen, np.int64, len(seen))].sum()))
        s = np.array(values)
        return pd.DataFrame({"severity": m.severity(s), "grade": (s[:, None] > m.thetas[None, :]).sum(axis=1)})

    udf = F.pandas_udf(scored, "severity double, grade int")
    out = docs.withColumn("_tx", udf(F.coalesce("text", F.lit(""))))
    return out.withColumns({"_tx_severity": F.col("_tx.severity"), "_tx_grade": F.col("_tx.grade")}).drop("_tx")


_CACHE: dict[str, dict[str, tuple[int, ...]]] = {}


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without those graded toxic; columns as given."""
    return score(docs, fit(docs, labels)).where("_tx_grade = 0").select(*docs.columns)


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id", F.col("_tx_severity").alias("severity"), F.col("_tx_grade").alias("grade"), (F.col("_tx_grade") > 0).alias("toxic")
    )
