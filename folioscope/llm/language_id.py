"""Language ID by a bidirectional gated recurrent network over bytes (operator 9).

Two GRUs read the UTF-8 bytes of a text forwards and backwards; a linear layer on
both states labels every byte with a language, and a document's probabilities
are the mean over its positions. The network is trained here, in numpy, by
backpropagation through time.

To read long texts in bounded memory and to use whole matrices, a text is cut
into spans of `span` bytes, and each span is read with `margin` bytes of context
before and after, whose own labels are not counted; every byte of every text is
labelled exactly once.

Training sees at most `max_docs` documents per language (smallest hash of
doc_id) and `spans_per_doc` spans of each, a documented bound for the classifier
only. Spans are drawn on the executors, by keyed hash, from anywhere in the whole
text; only they come to the driver. Prediction covers all texts in full.

Defined cases: a text that is null or has no letter is "und" with score 0; with
no labelled document at all every text is "und"; repeated rows are each
predicted; of rows that share a doc_id, training takes one that has the smallest
of their languages; only text is an input of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.common import ship


@dataclass
class BiGRU:
    """Per direction: input table (256, 3H) with biases folded in, recurrent weights (H, 3H); an output layer (2H, K)."""

    langs: list[str]
    tables: list[np.ndarray]
    recurrent: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray
    span: int = 256
    margin: int = 16

    @property
    def hidden(self) -> int:
        return self.recurrent[0].shape[0]

    def states(self, x: np.ndarray, d: int) -> list[np.ndarray]:
        """Hidden states of bytes x (T, B) read in direction d, in the order of x."""
        h = np.zeros((x.shape[1], self.hidden), np.float32)
        out = [h] * len(x)
        for t in range(len(x)) if d == 0 else range(len(x) - 1, -1, -1):
            h = self._step(x[t], h, d)[0]
            out[t] = h
        return out

    def _step(self, x: np.ndarray, h: np.ndarray, d: int):
        H = self.hidden
        a = self.tables[d][x]
        u = self.recurrent[d]
        g = a[:, : 2 * H] + h @ u[:, : 2 * H]
        np.multiply(g, 0.5, out=g)
        np.tanh(g, out=g)
        np.multiply(g, 0.5, out=g)
        np.add(g, 0.5, out=g)  # both gates: sigmoid by way of tanh
        z, r = g[:, :H], g[:, H:]
        rh = r * h
        c = np.tanh(a[:, 2 * H :] + rh @ u[:, 2 * H :])
        return c + z * (h - c), z, r, rh, c

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (T, B, K) of each position of x (T, B)."""
        f, b = self.states(x, 0), self.states(x, 1)
        H = self.hidden
        out = np.empty((len(x), x.shape[1], len(self.langs)), np.float32)
        for t in range(len(x)):
            y = f[t] @ self.out[:H] + b[t] @ self.out[H:] + self.bias
            y -= y.max(axis=1, keepdims=True)
            np.exp(y, out=y)
            out[t] = y / y.sum(axis=1, keepdims=True)
        return out

    def gradients(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray):
        """Loss and gradients by backpropagation through time. x, mask: (T, B); y: (B,)."""
        H, T, B = self.hidden, len(x), x.shape[1]
        kept = []
        for d in (0, 1):
            h, steps = np.zeros((B, H), np.float32), [None] * T
            for t in range(T) if d == 0 else range(T - 1, -1, -1):
                prev = h
                h, z, r, rh, c = self._step(x[t], prev, d)
                steps[t] = (prev, h, z, r, rh, c)
            kept.append(steps)
        g_out, g_bias = np.zeros_like(self.out), np.zeros_like(self.bias)
        g_tab = [np.zeros_like(t) for t in self.tables]
        g_rec = [np.zeros_like(u) for u in self.recurrent]
        total, loss = max(mask.sum(), 1), 0.0
        d_h = [[None] * T, [None] * T]
        for t in range(T):
            hf, hb = kept[0][t][1], kept[1][t][1]
            s = hf @ self.out[:H] + hb @ self.out[H:] + self.bias
            s -= s.max(axis=1, keepdims=True)
            p = np.exp(s)
            p /= p.sum(axis=1, keepdims=True)
            loss -= float((np.log(p[np.arange(B), y] + 1e-12) * mask[t]).sum()) / total
            p[np.arange(B), y] -= 1
            p *= (mask[t] / total)[:, None]
            g_out[:H] += hf.T @ p
            g_out[H:] += hb.T @ p
            g_bias += p.sum(axis=0)
            d_h[0][t], d_h[1][t] = p @ self.out[:H].T, p @ self.out[H:].T
        for d in (0, 1):
            u, carry = self.recurrent[d], np.zeros((B, H), np.float32)
            for t in range(T - 1, -1, -1) if d == 0 else range(T):
                prev, _, z, r, rh, c = kept[d][t]
                dh = d_h[d][t] + carry
                dc = dh * (1 - z) * (1 - c * c)
                dz = dh * (prev - c) * z * (1 - z)
                drh = dc @ u[:, 2 * H :].T
                dr = drh * prev * r * (1 - r)
                gates = np.concatenate([dz, dr], axis=1)
                carry = dh * z + drh * r + gates @ u[:, : 2 * H].T
                g_rec[d][:, : 2 * H] += prev.T @ gates
                g_rec[d][:, 2 * H :] += rh.T @ dc
                np.add.at(g_tab[d], x[t], np.concatenate([gates, dc], axis=1))
        return loss, [*g_tab, *g_rec, g_out, g_bias]

    def parameters(self) -> list[np.ndarray]:
        return [*self.tables, *self.recurrent, self.out, self.bias]

    # Whole texts -----------------------------------------------------------------

    def spans(self, data: bytes, a: int, b: int) -> np.ndarray:
        """Rows of margin + span + margin bytes for data[a:b]; zeros stand where the text ends."""
        n = -(-(b - a) // self.span)
        padded = np.zeros(n * self.span + 2 * self.margin, np.uint8)
        lo, hi = max(0, a - self.margin), min(len(data), b + self.margin)
        at = lo - a + self.margin
        padded[at : at + hi - lo] = np.frombuffer(data, np.uint8, hi - lo, lo)
        return np.lib.stride_tricks.sliding_window_view(padded, self.span + 2 * self.margin)[:: self.span]

    def pooled(self, texts: list[bytes], block: int = 2048) -> np.ndarray:
        """Mean probabilities of each text over all its bytes; blocks of spans bound the memory."""
        sums = np.zeros((len(texts), len(self.langs)))
        queue: list[tuple[np.ndarray, int, np.ndarray]] = []  # rows, text, bytes counted in each row

        def run() -> None:
            if not queue:
                return
            rows = np.concatenate([q[0] for q in queue])
            who = np.concatenate([np.full(len(q[2]), q[1]) for q in queue])
            n = np.concatenate([q[2] for q in queue])
            queue.clear()
            for k in range(0, len(rows), block):
                ix = slice(k, k + block)
                # Rows are always read at full length, so what a text gets never depends on its neighbours.
                body = self.probabilities(np.ascontiguousarray(rows[ix].T))[self.margin : self.margin + self.span]
                inside = np.arange(self.span)[:, None] < n[ix][None, :]
                np.add.at(sums, who[ix], (body * inside[:, :, None]).sum(axis=0))

        held = 0
        for i, data in enumerate(texts):
            for a in range(0, len(data), self.span * block):  # a very long text is queued piece by piece
                b = min(len(data), a + self.span * block)
                rows = self.spans(data, a, b)
                n = np.full(len(rows), self.span)
                n[-1] = b - a - (len(rows) - 1) * self.span
                queue.append((rows, i, n))
                held += len(rows)
                if held >= 4 * block:
                    run()
                    held = 0
        run()
        return sums / np.maximum(sums.sum(axis=1, keepdims=True), 1e-12)


def train(pieces: list[list[bytes]], labels: list[str], hidden: int = 8, span: int = 64, steps: int = 700, batch: int = 128, rate: float = 0.02, seed: int = 3) -> BiGRU:
    """A BiGRU fitted to spans of at most `span` bytes of labelled texts, by Adam and a falling rate."""
    rng = np.random.default_rng(seed)
    langs = sorted(set(labels))
    H, K = hidden, len(langs)
    model = BiGRU(
        langs,
        [rng.normal(0, 0.3, (256, 3 * H)).astype(np.float32) for _ in range(2)],
        [(np.linalg.qr(rng.normal(size=(3 * H, 3 * H)))[0][:H] * 0.8).astype(np.float32) for _ in range(2)],
        rng.normal(0, 0.3, (2 * H, K)).astype(np.float32),
        np.zeros(K, np.float32),
    )
    if K < 2:
        return model
    xs, ys = [], []
    for own, l in zip(pieces, labels, strict=True):
        for data in own:
            row, piece = np.zeros(span, np.uint8), np.frombuffer(data, np.uint8)
            if len(piece) == 0:
                continue
            if rng.random() < 0.4:  # short texts, and the starts and ends of longer ones, have zeros around them
                piece = piece[: rng.integers(6, span)]
            at = rng.integers(0, span - len(piece) + 1)
            row[at : at + len(piece)] = piece
            xs.append(row)
            ys.append(langs.index(l))
    if not xs:
        return model
    x, y = np.array(xs), np.array(ys)
    by = [np.flatnonzero(y == k) for k in range(K)]
    m = [np.zeros_like(p) for p in model.parameters()]
    v = [np.zeros_like(p) for p in model.parameters()]
    for step in range(1, steps + 1):
        ix = np.concatenate([rng.choice(b, max(1, batch // K)) for b in by if len(b)])  # as many of each language
        loss, grads = model.gradients(np.ascontiguousarray(x[ix].T), y[ix], (x[ix].T != 0).astype(np.float32))
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        scale = min(1.0, 1.0 / (norm + 1e-9))
        lr = rate * 0.5 * (1 + np.cos(np.pi * step / steps)) + 1e-4
        for p, g, a, b in zip(model.parameters(), grads, m, v, strict=True):
            a += 0.1 * (g * scale - a)
            b += 0.01 * (g * g * scale * scale - b)
            p -= (lr * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def drawn_spans(text: F.Column, key: F.Column, n: int, span: int) -> F.Column:
    """The first span of a text and n - 1 others that a keyed hash picks from its whole length."""
    data = F.encode(text, "utf-8")
    room = F.greatest(F.octet_length(text) - span, F.lit(0)) + 1
    starts = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda j: F.when(j == 0, 0).otherwise(F.pmod(F.xxhash64(key, j), room)).cast("int"))
    return F.transform(F.sort_array(F.array_distinct(starts)), lambda a: F.substring(data, a + 1, F.lit(span)))


def fit(docs: DataFrame, max_docs: int = 400, spans_per_doc: int = 8, span: int = 64) -> BiGRU | None:
    """Trains on documents with a language that aren't held out. None if there are none."""
    from pyspark.sql import Window

    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~F.coalesce(held_out(), F.lit(True)))
    ranked = usable.select("doc_id", "lang", F.xxhash64("doc_id").alias("h")).withColumn("part", F.pmod("h", F.lit(256)))
    # First within small parts of a language, then over what these keep, so that no task meets a whole language.
    for by in (["lang", "part"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*by).orderBy("h", "doc_id"))
        ranked = ranked.withColumn("k", place).where(F.col("k") <= (max(1, -(-max_docs // 32)) if len(by) > 1 else max_docs))
    picked = ranked.groupBy("doc_id").agg(F.min("lang").alias("y"))
    one = F.struct(F.xxhash64("text").alias("h"), drawn_spans(F.col("text"), F.col("doc_id"), spans_per_doc, span).alias("spans"))
    rows = (
        usable.select("doc_id", "text", "lang")
        .join(F.broadcast(picked), "doc_id")  # at most max_docs per language
        .where("lang = y")
        .groupBy("doc_id", "y")
        .agg(F.min(one).alias("x"))
        .select("doc_id", "y", "x.spans")
        .orderBy("doc_id")
        .collect()
    )
    if not rows:
        return None
    return train([[bytes(s) for s in r["spans"]] for r in rows], [r["y"] for r in rows], span=span)


def predict(docs: DataFrame, model: BiGRU | None) -> DataFrame:
    """(all columns of docs, _li_lang, _li_score), from text alone."""
    if model is None:
        return docs.withColumns({"_li_lang": F.lit("und"), "_li_score": F.lit(0.0)})
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predicted(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for text in parts:
            p = m.pooled([t.encode() for t in text]) if len(text) else np.zeros((0, len(m.langs)))
            best = p.argmax(axis=1) if len(p) else np.zeros(0, int)
            yield pd.DataFrame({"lang": [m.langs[k] for k in best], "score": p[np.arange(len(p)), best].astype(float)})

    udf = F.pandas_udf(predicted, "lang string, score double")
    lettered = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))
    out = docs.withColumn("_li", udf(F.when(lettered, F.col("text")).otherwise(F.lit(""))))
    return out.withColumns(
        {
            "_li_lang": F.when(lettered, F.col("_li.lang")).otherwise("und"),
            "_li_score": F.when(lettered, F.col("_li.score")).otherwise(0.0),
        }
    ).drop("_li")


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.select("doc_id", "text", "lang"))
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), F.col("_li_lang").alias("lang_pred"), F.col("_li_score").alias("score")
    )
