"""Text-similarity metrics of a reference answer and a model's answer.

BLEU and ROUGE-1/2 are array expressions. ROUGE-L (longest common
subsequence) and METEOR (alignment) are Arrow UDFs: no built-in expresses them.
Model-based scores take any encoder (`functions.encoders`).
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.arrays import bag_overlap, let, ngrams
from folioscope.functions.stemming import porter
from folioscope.functions.text import pysplit, pytrim, truthy
from folioscope.shipping import ship

METRICS = ["bleu", "rouge1", "rouge2", "rougeL", "meteor", "bertscore_f1", "semantic_similarity"]
#: Message of a row whose texts don't allow metrics. A fixed value of the report format.
EMPTY_TEXT = "Пустой correct_answer или model_answer"


def bleu(reference: Column, hypothesis: Column) -> Column:
    """Sentence BLEU-4 over white-space tokens; a zero count of matches is smoothed to 0.1."""

    def of(t: Column) -> Column:
        r, h = t["r"], t["h"]
        matches = F.struct(*[bag_overlap(ngrams(h, n), ngrams(r, n)).cast("double").alias(f"m{n}") for n in range(1, 5)])

        def score(m: Column) -> Column:
            log_precision = lambda n: F.ln(F.when(m[f"m{n}"] == 0, F.lit(0.1)).otherwise(m[f"m{n}"]) / F.greatest(F.lit(1), F.size(h) - (n - 1)))
            brevity = F.when(F.size(h) > F.size(r), F.lit(1.0)).when(F.size(h) == 0, F.lit(0.0)).otherwise(F.exp(1 - F.size(r) / F.size(h)))
            logs = sum((log_precision(n) for n in (2, 3, 4)), log_precision(1)) / 4
            return F.when(m["m1"] == 0, F.lit(0.0)).otherwise(brevity * F.exp(logs))

        return let(matches, score)  # each overlap is counted once

    return let(F.struct(pysplit(reference).alias("r"), pysplit(hypothesis).alias("h")), of)


def rouge_tokens(c: Column) -> Column:
    """Lower-cased runs of ASCII letters and digits: text in other scripts has none."""
    return F.array_remove(F.split(F.lower(c), "[^a-z0-9]+"), "")


def _stem_series(tokens: pd.Series) -> pd.Series:
    return tokens.map(lambda ts: [porter(t) if len(t) > 3 else t for t in ts])


def stemmed(tokens: Column) -> Column:
    """Porter stems of tokens of more than three characters."""
    ship()
    return F.pandas_udf(_stem_series, "array<string>")(tokens)


def f_measure(overlap: Column, n_reference: Column, n_hypothesis: Column) -> Column:
    def of(x: Column) -> Column:
        p, r = x["o"] / F.greatest(x["h"], F.lit(1)), x["o"] / F.greatest(x["r"], F.lit(1))
        return F.when(x["o"] > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))

    # The overlap is costly and used several times, so it is bound.
    return let(F.struct(overlap.cast("double").alias("o"), n_hypothesis.alias("h"), n_reference.alias("r")), of)


def rouge_n(reference_tokens: Column, hypothesis_tokens: Column, n: int) -> Column:
    return let(
        F.struct(ngrams(reference_tokens, n).alias("r"), ngrams(hypothesis_tokens, n).alias("h")),
        lambda t: f_measure(bag_overlap(t["h"], t["r"]), F.size(t["r"]), F.size(t["h"])),
    )


def lcs_length(a: list, b: list) -> int:
    """Longest common subsequence by bit-parallel dynamic programming on one big integer."""
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for y in b:
        u = v & places.get(y, 0)
        v = (v + u | v - u) & full
    return len(a) - v.bit_count()


def _lcs_series(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([lcs_length(list(x), list(y)) for x, y in zip(a, b, strict=True)], dtype="int32")


def lcs(a: Column, b: Column) -> Column:
    ship()
    return F.pandas_udf(_lcs_series, "int")(a, b)


def rouge_l(reference_tokens: Column, hypothesis_tokens: Column) -> Column:
    return f_measure(lcs(reference_tokens, hypothesis_tokens), F.size(reference_tokens), F.size(hypothesis_tokens))


_SENTENCE = re.compile(r"(?<=[.?!])(?<!\b\w\.)\s+")
_TOKEN = re.compile(r"\.{2,}|[«“„‘»”’–—\"]|[;@#$%&?!*()\[\]{}<>]|[:,](?!\d)|--")


def meteor_tokens(text: str) -> list[str]:
    """Words and punctuation, lower-cased; a period is split off at the end of a sentence only."""
    out = []
    for s in _SENTENCE.split(text):
        s = re.sub(r"(?<!\.)\.(?=[\]\)}>\"'»”’]*\s*$)", " . ", s)
        out += _TOKEN.sub(lambda m: f" {m[0]} ", s).split()
    return [t.lower() for t in out]


def meteor_score(reference: str, hypothesis: str) -> float:
    """METEOR with exact and stem matches, aligned greedily from the right; no synonym stage."""
    ref, hyp = list(enumerate(meteor_tokens(reference))), list(enumerate(meteor_tokens(hypothesis)))
    n_ref, n_hyp, pairs = len(ref), len(hyp), []
    for form in (lambda t: t, porter):
        places: dict[str, list[int]] = {}
        for at, (_, t) in enumerate(ref):
            places.setdefault(form(t), []).append(at)
        used_ref, used_hyp = set(), set()
        for at in range(len(hyp) - 1, -1, -1):
            left = places.get(form(hyp[at][1]))
            if left:
                r = left.pop()
                pairs.append((hyp[at][0], ref[r][0]))
                used_ref.add(r)
                used_hyp.add(at)
        ref = [x for i, x in enumerate(ref) if i not in used_ref]
        hyp = [x for i, x in enumerate(hyp) if i not in used_hyp]
    if not pairs:
        return 0.0
    pairs.sort()
    m = len(pairs)
    chunks = 1 + sum(b != (a[0] + 1, a[1] + 1) for a, b in zip(pairs, pairs[1:], strict=False))
    p, r = m / n_hyp, m / n_ref
    return p * r / (0.9 * p + 0.1 * r) * (1 - 0.5 * (chunks / m) ** 3)


def _meteor_series(reference: pd.Series, hypothesis: pd.Series) -> pd.Series:
    return pd.Series([meteor_score(r or "", h or "") for r, h in zip(reference, hypothesis, strict=True)], dtype="float64")


def meteor(reference: Column, hypothesis: Column) -> Column:
    ship()
    return F.pandas_udf(_meteor_series, "double")(reference, hypothesis)


Scorer = Callable[[str, str], float]


def guarded(scorer: Scorer) -> Callable[[Column, Column], Column]:
    """A model's score per row as (value, error): an exception is a message in its row, not the job's end."""

    def run(reference: pd.Series, hypothesis: pd.Series) -> pd.DataFrame:
        out = []
        for r, h in zip(reference, hypothesis, strict=True):
            try:
                out.append((float(scorer(r, h)) if r and h else None, None))
            except Exception as e:  # noqa: BLE001
                out.append((None, str(e)))
        return pd.DataFrame(out, columns=["value", "error"])

    return F.pandas_udf(run, "value double, error string")


def score_answers(answered: DataFrame, scorers: dict[str, Scorer] | None = None, use_stemmer: bool = True) -> DataFrame:
    """Metric rows of answered(question, answer, correct_answer?, model_answer, status).

    scorers: functions of two texts for bertscore_f1 and semantic_similarity, such as
    encoders.scorers(); null without them. A row with an empty text on either side, and a row for
    which a scorer raises, has null metrics and a message. Other columns are dropped.
    """
    scorers = scorers or {}
    text = lambda c: F.col(c).cast("string") if c in answered.columns else F.lit(None).cast("string")
    safe = lambda c: F.coalesce(pytrim(c), F.lit(""))
    # Trimmed after choosing: a blank answer wins over correct_answer and then is empty.
    rows = answered.select(
        safe(text("question")).alias("question"),
        safe(F.coalesce(truthy(text("answer")), text("correct_answer"))).alias("correct_answer"),
        safe(text("model_answer")).alias("model_answer"),
        safe(text("status")).alias("status"),
    )
    ref, hyp = F.col("correct_answer"), F.col("model_answer")
    tokens = (lambda c: stemmed(rouge_tokens(c))) if use_stemmer else rouge_tokens
    rows = rows.withColumns({"_r": tokens(ref), "_h": tokens(hyp), "_ok": (ref != "") & (hyp != "")})
    found = {
        "bleu": bleu(ref, hyp),
        "rouge1": rouge_n(F.col("_r"), F.col("_h"), 1),
        "rouge2": rouge_n(F.col("_r"), F.col("_h"), 2),
        "rougeL": rouge_l(F.col("_r"), F.col("_h")),
        "meteor": meteor(ref, hyp),
    }
    rows = rows.withColumns({f"_{m}": guarded(f)(ref, hyp) for m, f in scorers.items()})
    problems = [F.col(f"_{m}.error") for m in scorers]
    error = F.when(~F.col("_ok"), EMPTY_TEXT).otherwise(F.coalesce(*problems, F.lit(None)) if problems else F.lit(None))
    rows = rows.withColumn("metrics_error", error)
    found |= {m: F.col(f"_{m}.value") if m in scorers else F.lit(None).cast("double") for m in METRICS if m not in found}
    rows = rows.withColumns({m: F.when(F.col("metrics_error").isNull(), c) for m, c in found.items()})
    return rows.select("question", "correct_answer", "model_answer", "status", *METRICS, "metrics_error")


def mean_metrics(rows: DataFrame) -> DataFrame:
    """(metric, mean) of the metrics that have any value; nulls are skipped."""
    means = rows.agg(*[F.avg(m).alias(m) for m in METRICS if m in rows.columns])
    return means.unpivot([], [m for m in METRICS if m in rows.columns], "metric", "mean").where("mean is not null")
