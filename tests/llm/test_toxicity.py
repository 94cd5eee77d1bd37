import numpy as np

from folioscope.llm import toxicity as tx


def test_thresholds_stay_in_order_and_share_weights():
    rng = np.random.default_rng(0)
    grades = rng.integers(0, 3, 600)
    rows = [np.unique(np.concatenate([rng.integers(100, 200, 5), np.arange(1, 1 + 3 * g)])).astype(np.int64) for g in grades]
    m = tx.fit_ordinal(tx.Sparse(rows), grades, 10)
    assert len(m.thetas) == 2 and m.thetas[0] < m.thetas[1]
    score = np.array([m.weights[r].sum() for r in rows])
    assert ((score[:, None] > m.thetas).sum(axis=1) == grades).mean() > 0.95
    s = m.severity(score)
    assert s[grades == 2].mean() > s[grades == 1].mean() > s[grades == 0].mean() and (s >= 0).all() and (s <= 2).all()


def test_degenerate_labels_are_never_toxic():
    for grades in ([], [0, 0], [1, 1]):
        m = tx.fit_ordinal(tx.Sparse([np.array([1])] * len(grades)), np.array(grades, dtype=np.int64), 8)
        assert m.severity(np.array([0.0]))[0] < 1e-6


def corpus(words, n=240):
    rows = []
    for i in range(n):
        text = words(80, i)
        if i % 4 == 0:
            w = text.split()
            w.insert(i % 70, "Vilest,")
            w.insert(i % 50, "grubwort" + "aeiou"[i % 5])
            text = " ".join(w)
        rows.append((i, text))
    return rows


def labels(spark, n=240):
    rows = [(i, 1, int(i % 4 == 0), "x") for i in range(n)]
    return spark.createDataFrame(rows + [(3, 1, 0, "x"), (None, 1, 1, "x"), (5, 1, None, "x"), (9999, 0, 1, "x")], "doc_id long, quality int, toxic int, y string")


def test_toxic_documents_are_found(spark, frame_of, words):
    rows = corpus(words)
    model = tx.fit(frame_of(rows), labels(spark).where("doc_id < 160 or doc_id is null"))
    got = {r.doc_id: r for r in tx.score(frame_of(rows), model).collect()}
    assert {i for i, r in got.items() if r._tx_grade > 0} == {i for i, _ in rows if i % 4 == 0}
    assert len({r._tx_grade for r in got.values()}) >= 2
    kept = tx.keep_clean(frame_of(rows), labels(spark))
    assert kept.columns == frame_of(rows).columns and kept.count() == 180


def test_messy_and_empty(spark, messy, messy_rows, nothing, frame_of, words):
    model = tx.fit(frame_of(corpus(words)), labels(spark))
    out = tx.score(messy, model)
    assert out.count() == len(messy_rows) and out.where("_tx_grade > 0").count() == 0
    assert tx.score(nothing, model).count() == 0
    none = tx.fit(messy, labels(spark).limit(0))
    assert tx.score(messy, none).where("_tx_grade > 0").count() == 0
    assert tx.keep_clean(nothing, labels(spark).limit(0)).count() == 0


def test_repeated_rows_score_alike(spark, frame_of, words):
    rows = corpus(words) + corpus(words)
    got = tx.score(frame_of(rows), tx.fit(frame_of(rows), labels(spark)))
    assert got.groupBy("doc_id").agg({"_tx_severity": "max"}).count() == 240
    assert got.selectExpr("doc_id", "_tx_severity").distinct().count() == 240
