"""Quality rules as a learned decision list (operator 3, native).

Features of a text are Spark expressions evaluated in its own row, with no
shuffle. A decision list is learned by sequential covering: rules that reject
are grown one threshold condition at a time by information gain on two thirds
of the labelled sample, pruned from the end on the other third, and kept while
they stay precise; each rule removes what it covers before the next is grown.
The list becomes one ordered CASE expression, so applying it is a projection.

The learner sees at most `max_rows` labelled documents, those with the smallest
hash of doc_id: a documented bound for the classifier only. Features, base
rules and verdicts are computed for every document over its whole text.

Defined cases: a null, empty or blank text has no words and fails the base
rule; a document labelled several times counts as bad if any label is 0; with
no labels at all the list is empty and only the base rule decides; other
columns are ignored; repeated rows are each scored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.arrays import let
from folioscope.llm.common import SPACE_PATTERN, WS

WINDOW = 5
#: Characters that count as symbols. Fixed values.
SYMBOLS = "[#*$%&|<>]"


def repeat_words(ws: Column) -> Column:
    """Words covered by 5-word windows that occur twice or more, the first occurrence included."""
    def windows(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(F.slice(w, i + 1, WINDOW))
        )

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        positions = let(
            ordered,
            lambda s: F.sort_array(
                F.transform(
                    F.filter(
                        s,
                        lambda e, i: F.coalesce(F.get(s, i + 1)["x"] == e["x"], F.lit(False))
                        | F.coalesce(F.get(s, i - 1)["x"] == e["x"], F.lit(False)),
                    ),
                    lambda e: e["i"],
                )
            ),
        )
        return let(
            positions,
            lambda p: F.aggregate(
                F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
                F.lit(0),
                lambda a, x: a + x,
            ),
        )

    return F.when(F.size(ws) <= WINDOW, F.lit(0)).otherwise(
        let(windows(ws), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
    ).cast("bigint")


#: Ratios that rules may test.
FEATURES = ["n_words", "symbols", "upper", "bangs", "mean_chars", "digits", "dup_lines", "repeats", "distinct", "line_words"]


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, counts of the base rule, one double per name in FEATURES prefixed with f_)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(
        "doc_id", text.alias("t"), F.array_remove(F.split(text, SPACE_PATTERN), "").alias("w")
    ).select(
        "doc_id",
        F.size("w").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        let(
            F.filter(F.split("t", "\n", -1), lambda x: F.trim(x, F.lit(WS)) != ""),
            lambda x: F.struct((F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("dup"), F.size(x).alias("all")),
        ).alias("lines"),
        repeat_words(F.col("w")).alias("n_repeat_words"),
        F.size(F.array_distinct("w")).alias("n_distinct"),
        F.regexp_count("t", F.lit("[A-Z]")).alias("n_upper"),
        F.regexp_count("t", F.lit("!")).alias("n_bangs"),
        F.regexp_count("t", F.lit("[0-9]")).alias("n_digits"),
    )
    per = lambda a, b: (F.col(a) / F.greatest(F.col(b), F.lit(1))).cast("double")
    return base.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        F.col("lines.dup").alias("n_dup_lines"),
        "n_repeat_words",
        F.col("n_words").cast("double").alias("f_n_words"),
        per("n_symbols", "n_words").alias("f_symbols"),
        per("n_upper", "word_chars").alias("f_upper"),
        per("n_bangs", "n_words").alias("f_bangs"),
        per("word_chars", "n_words").alias("f_mean_chars"),
        per("n_digits", "word_chars").alias("f_digits"),
        per("lines.dup", "lines.all").alias("f_dup_lines"),
        per("n_repeat_words", "n_words").alias("f_repeats"),
        per("n_distinct", "n_words").alias("f_distinct"),
        per("n_words", "lines.all").alias("f_line_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, row: dict) -> bool:
        return row[self.feature] > self.threshold if self.above else row[self.feature] <= self.threshold

    def column(self) -> Column:
        c = F.col(f"f_{self.feature}")
        return c > self.threshold if self.above else c <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, row: dict) -> bool:
    return all(c.holds(row) for c in rule)


def _counts(rule: Rule, rows: list[dict]) -> tuple[int, int]:
    hit = [r["bad"] for r in rows if _covers(rule, r)]
    return sum(hit), len(hit) - sum(hit)


def _cuts(rows: list[dict], n: int = 24) -> dict[str, list[float]]:
    out = {}
    for f in FEATURES:
        v = sorted({r[f] for r in rows})
        mids = [(a + b) / 2 for a, b in zip(v, v[1:], strict=False)]
        out[f] = mids if len(mids) <= n else sorted({mids[round(i * (len(mids) - 1) / (n - 1))] for i in range(n)})
    return out


def _grow(rows: list[dict], max_conditions: int) -> Rule:
    rule: Rule = ()
    while len(rule) < max_conditions:
        p0, n0 = sum(r["bad"] for r in rows), sum(1 - r["bad"] for r in rows)
        if not p0 or not n0:
            break
        base, best = math.log2(p0 / (p0 + n0)), (0.0, None)
        for f, cuts in _cuts(rows).items():
            ordered = sorted((r[f], r["bad"]) for r in rows)
            k = p = n = 0
            for t in cuts:
                while k < len(ordered) and ordered[k][0] <= t:
                    p, n, k = p + ordered[k][1], n + 1 - ordered[k][1], k + 1
                for above, pp, nn in ((False, p, n), (True, p0 - p, n0 - n)):
                    if pp and (gain := pp * (math.log2(pp / (pp + nn)) - base)) > best[0] + 1e-12:
                        best = (gain, Condition(f, above, t))
        if best[1] is None:
            break
        rule += (best[1],)
        rows = [r for r in rows if best[1].holds(r)]
    return rule


def _prune(rule: Rule, rows: list[dict]) -> Rule:
    def worth(x: Rule) -> float:
        p, n = _counts(x, rows)
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth, default=rule)


def learn(rows: list[dict], min_precision: float = 0.97, min_support: int = 5, max_rules: int = 12, max_conditions: int = 4) -> list[Rule]:
    """Ordered rules that reject. rows: feature values and bad (0 or 1)."""
    rules: list[Rule] = []
    left = list(rows)
    while len(rules) < max_rules and any(r["bad"] for r in left):
        grow = [r for i, r in enumerate(left) if i % 3]
        prune = [r for i, r in enumerate(left) if not i % 3]
        rule = _prune(_grow(grow, max_conditions), prune)
        p, n = _counts(rule, left) if rule else (0, 0)
        if p < min_support or p < min_precision * (p + n):
            break
        rules.append(rule)
        left = [r for r in left if not _covers(rule, r)]
    return rules


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that rejects, 0 if none does: an ordered conditional expression."""
    out = None
    for i, rule in enumerate(rules, 1):
        test = F.lit(True)
        for c in rule:
            test = test & c.column()
        out = F.when(test, i) if out is None else out.when(test, i)
    return F.lit(0) if out is None else out.otherwise(0)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 6000) -> list[Rule]:
    """A decision list from at most max_rows labelled documents."""
    sample = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg((F.min("quality") == 0).cast("int").alias("bad"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    # At most max_rows ids, so broadcasting them is bounded.
    joined = docs.select("doc_id", "text").join(F.broadcast(sample.select("doc_id")), "doc_id", "left_semi")
    found = features(joined).select("doc_id", *[F.col(f"f_{f}").alias(f) for f in FEATURES])
    rows = [r.asDict() for r in found.dropDuplicates(["doc_id"]).join(F.broadcast(sample), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    return learn(rows)


def apply_rules(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Counts, base_failed, rule (first that rejects, or 0) and kept, per document."""
    out = features(docs).withColumns({"base_failed": base_failed(), "rule": verdict(rules)})
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)).drop(*[f"f_{f}" for f in FEATURES])


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rules = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return apply_rules(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )
