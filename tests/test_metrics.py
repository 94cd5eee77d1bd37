import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscope.functions import encoders
from folioscope.functions import metrics as m


def score(spark, column, *pairs):
    df = spark.createDataFrame([(i, r, h) for i, (r, h) in enumerate(pairs)], "i int, r string, h string")
    return [x["y"] for x in df.select("i", column(F.col("r"), F.col("h")).alias("y")).orderBy("i").collect()]


def test_bleu(spark):
    same, none, part, short = score(spark, m.bleu, ("a b c d e", "a b c d e"), ("a b", "c d"), ("a b c d", "a b x y"), ("a b c d", "a b"))
    assert same == pytest.approx(1.0) and none == 0.0
    assert part == pytest.approx(math.exp(sum(map(math.log, (2 / 4, 1 / 3, 0.1 / 2, 0.1))) / 4))
    assert short == pytest.approx(math.exp(1 - 4 / 2) * math.exp(sum(map(math.log, (1, 1, 0.1, 0.1))) / 4))


def test_rouge(spark):
    tokens = m.rouge_tokens
    one = lambda r, h: m.rouge_n(tokens(r), tokens(h), 1)
    two = lambda r, h: m.rouge_n(tokens(r), tokens(h), 2)
    longest = lambda r, h: m.rouge_l(tokens(r), tokens(h))
    pairs = (("the cat sat", "The cat, the CAT"), ("только кириллица 1724", "год 1724"), ("", "a"))
    assert score(spark, one, *pairs) == pytest.approx([2 * (2 / 4) * (2 / 3) / (2 / 4 + 2 / 3), 1.0, 0.0])
    assert score(spark, two, *pairs) == pytest.approx([2 * (1 / 3) * (1 / 2) / (1 / 3 + 1 / 2), 0.0, 0.0])
    assert score(spark, longest, ("a b c d", "a x c d")) == pytest.approx([0.75])


def test_lcs_equals_dynamic_programming():
    import random

    rnd = random.Random(1)
    for _ in range(200):
        a, b = ([rnd.choice("abc") for _ in range(rnd.randrange(12))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            row = [0] + [0] * len(b) if not b else _next(row, x, b)
        assert m.lcs_length(a, b) == row[-1]


def _next(row, x, b):
    out = [0]
    for j, y in enumerate(b):
        out.append(row[j] + 1 if x == y else max(out[-1], row[j + 1]))
    return out


def test_meteor():
    assert m.meteor_score("the cat", "dog") == 0.0
    assert m.meteor_score("a b c", "a b c") == pytest.approx(1 - 0.5 / 27)
    assert m.meteor_score("running fast", "runs fast") == pytest.approx(1 - 0.5 / 8)  # by stems


def test_answers_are_chosen_before_they_are_trimmed(spark):
    rows = [("q1", "  ", "fallback", "x", "ok"), ("q2", "", " fallback ", "fallback", "ok"), ("q3", "a", None, None, "error")]
    df = spark.createDataFrame(rows, "question string, answer string, correct_answer string, model_answer string, status string")
    got = {r.question: r for r in m.score_answers(df, use_stemmer=True).collect()}
    assert got["q1"].correct_answer == "" and got["q1"].bleu is None and got["q1"].metrics_error == m.EMPTY_TEXT
    assert got["q2"].correct_answer == "fallback" and got["q2"].rouge1 == 1.0 and got["q2"].metrics_error is None
    assert got["q3"].status == "error" and got["q3"].meteor is None
    means = {r.metric: r["mean"] for r in m.mean_metrics(m.score_answers(df)).collect()}
    assert means["rouge1"] == 1.0 and "bertscore_f1" not in means
    assert m.mean_metrics(m.score_answers(df.limit(0))).count() == 0


def test_scorers_are_plug_points_and_may_fail(spark):
    df = spark.createDataFrame([("q", "a", "b"), ("r", "a", "boom")], "question string, answer string, model_answer string")

    def half(reference, hypothesis):
        if hypothesis == "boom":
            raise RuntimeError("no score")
        return 0.5

    got = {r.question: r for r in m.score_answers(df, {"bertscore_f1": half}).collect()}
    assert got["q"].bertscore_f1 == 0.5 and got["q"].bleu == 0.0 and got["q"].metrics_error is None
    assert got["r"].metrics_error == "no score" and all(got["r"][x] is None for x in m.METRICS)


def test_bertscore_takes_the_best_match_of_each_token():
    angles = {"east": 0, "north": 90, "between": 45, "west": 180}
    encode = lambda t: np.array([[math.cos(math.radians(angles[w])) * 3, math.sin(math.radians(angles[w])) * 3] for w in t.split()]).reshape(-1, 2)
    f1 = encoders.bertscore_f1(encode)
    half = math.sqrt(0.5)
    assert f1("east north", "east north") == pytest.approx(1.0)
    p, r = half, (half + half) / 2
    assert f1("east north", "between") == pytest.approx(2 * p * r / (p + r))
    p, r = (1 + half) / 2, (1 + half) / 2
    assert f1("east north", "east between") == pytest.approx(2 * p * r / (p + r))
    assert f1("east", "west") == 0.0 and f1("", "east") == 0.0 and f1("east", "") == 0.0
    words = [f"w{i % 700}" for i in range(3 * encoders.BLOCK + 1)]
    assert encoders.bertscore_f1(encoders.word_vectors)(" ".join(words[::-1]), " ".join(words)) == pytest.approx(1.0)


def test_semantic_similarity_is_a_cosine():
    of = encoders.semantic_similarity(lambda t: [t.count("a"), t.count("b")])
    assert of("aab", "b") == pytest.approx(1 / math.sqrt(5)) and of("x", "a") == 0.0


def test_model_scores_have_means(spark):
    rows = [("q", "one two", "two one", "ok"), ("r", "three", "", "error")]
    scored = m.score_answers(spark.createDataFrame(rows, "question string, answer string, model_answer string, status string"), encoders.scorers())
    assert {r.metric: r["mean"] for r in m.mean_metrics(scored).collect()}["bertscore_f1"] == pytest.approx(1.0)
    assert {r.question: r.semantic_similarity for r in scored.collect()} == {"q": pytest.approx(1.0), "r": None}
