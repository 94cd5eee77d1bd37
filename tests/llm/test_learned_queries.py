"""The registered queries that SQL can't express, column by column against plain Python."""

import re
import unicodedata
import zlib

import numpy as np
import pytest

from folioscope.llm import language_id, pieces, quality_rules, queries, toxicity
from test_quality_rules import brute


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def rows_of(name, spark, sf_dir):
    rows = queries.QUERIES[name](spark, sf_dir).collect()
    out = {r.doc_id: r for r in rows}
    assert len(out) == len(rows)
    return out


def test_op3(spark, sf_dir, docs, texts, labels):
    got = rows_of("op3_quality_rules", spark, sf_dir)
    assert set(got) == set(texts)
    rules = quality_rules.fit(docs, labels)
    assert rules
    values = {r.doc_id: {f: r[f"f_{f}"] for f in quality_rules.FEATURES} for r in quality_rules.features(docs).collect()}
    for i, t in texts.items():
        r, (n, *counts) = got[i], brute(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, *counts)
        assert r.base_failed == (n < 10 or 100 * counts[3] > 20 * n)
        first = next((k for k, rule in enumerate(rules, 1) if all(values[i][c.feature] > c.threshold if c.above else values[i][c.feature] <= c.threshold for c in rule)), 0)
        assert (r.rule, r.kept) == (first, not r.base_failed and first == 0)


def test_op3_on_labels_it_has_not_seen(spark, docs, labels):
    """Learned from half of the labelled documents of sf0.1, judged on the other half.

    The floors guard against getting worse. They are below what was measured, which README states along with
    larger and smaller tables; half of sf0.01's labels find only 17 of 34.
    """
    big, given = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rules = quality_rules.fit(big, given.where("doc_id % 2 = 0"))
    judged = quality_rules.apply_rules(big, rules).join(given.where("doc_id % 2 = 1"), "doc_id").select("kept", "base_failed", "rule", "quality").collect()
    good = [r for r in judged if r.quality == 1 and not r.base_failed]
    bad = [r for r in judged if r.quality == 0]
    print("op3 held out:", sum(r.rule == 0 for r in good), len(good), sum(not r.kept for r in bad), len(bad))
    assert sum(r.rule == 0 for r in good) >= 0.97 * len(good) and sum(not r.kept for r in bad) >= 0.8 * len(bad)


def test_op7(spark, sf_dir, texts):
    got = rows_of("op7_pieces", spark, sf_dir)
    v = pieces.Vocabulary.load(pieces.default_model())
    assert set(got) == set(texts)
    for i, t in texts.items():
        r = got[i]
        assert r.lossless and r.n_pieces == len(r.ids)
        assert v.decode(r.ids) == t
        if len(t) < 3000:
            assert list(r.ids) == v.encode(t, 0.1, 17, i)


def test_op9(spark, sf_dir, docs, texts):
    got = rows_of("op9_language_id", spark, sf_dir)
    assert set(got) == set(texts)
    model = language_id.fit(docs.select("doc_id", "text", "lang"))
    learned = {r.lang for r in docs.where("lang is not null").collect()}
    for i, t in texts.items():
        r = got[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        if not any(unicodedata.category(c).startswith("L") for c in t):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        (p,) = model.pooled([t.encode()])
        assert r.lang_pred == model.langs[int(p.argmax())] and r.lang_pred in learned
        assert r.score == pytest.approx(float(p.max()), abs=1e-4) and 0 <= r.score <= 1


def severity(model, text):
    """From the definition: distinct lower-cased words and their prefixes, each once."""
    import xxhash

    names = set()
    for w in re.findall(r"\w+", text.lower()):
        names |= {"w" + w} | {"p" + w[:k] for k in (4, 5, 6) if len(w) >= k}
    score = sum(float(model.weights[h]) for h in {xxhash.xxh3_64_intdigest(x) & ((1 << model.bits) - 1) for x in names})
    return score, sum(1 / (1 + np.exp(-(score - t))) for t in model.thetas)


def test_op10(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")  # the smallest table has too few toxic labels to learn from
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    got = rows_of("op10_toxicity", spark, sf_dir)
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    model = toxicity.fit(docs, labels)
    assert set(got) == set(texts) and (model.weights != 0).sum() > 5
    for i, t in texts.items():
        score, expected = severity(model, t)
        assert got[i].severity == pytest.approx(expected, abs=1e-4)
        if min(abs(score - model.thetas)) > 1e-3:
            assert got[i].grade == sum(score > t for t in model.thetas)
        assert got[i].toxic == (got[i].grade > 0)


def test_op10_on_labels_it_has_not_seen(spark):
    """Learned from half of the labelled documents of sf0.1, judged on the other half.

    Measured: 205 of 231 toxic ones are found and 44 of 1,814 clean ones flagged, as prefixes that a few toxic texts share by
    chance pass for evidence in so small a sample. The bounds only guard against getting worse; README has the figures of larger samples.
    """
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels.where("doc_id % 2 = 0"))
    judged = toxicity.score(docs.join(labels.where("doc_id % 2 = 1"), "doc_id"), model).select("toxic", "_tx_grade").collect()
    toxic, clean = ([r for r in judged if r.toxic == k] for k in (1, 0))
    print("op10 held out:", sum(r._tx_grade > 0 for r in toxic), len(toxic), sum(r._tx_grade > 0 for r in clean), len(clean))
    assert sum(r._tx_grade > 0 for r in toxic) >= 0.85 * len(toxic) and sum(r._tx_grade > 0 for r in clean) <= 0.03 * len(clean)


def test_a_word_of_no_evidence_rejects_nothing(spark, sf_dir, docs, labels):
    with pytest.warns(UserWarning, match="nothing will be graded toxic"):
        model = toxicity.fit(docs.limit(40), labels)
    assert toxicity.score(docs, model).where("_tx_grade > 0").count() == 0
