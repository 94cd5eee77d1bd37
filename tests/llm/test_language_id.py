import zlib

import numpy as np

from folioscope.llm import language_id as li


def tiny(seed=0, hidden=3):
    rng = np.random.default_rng(seed)
    f = lambda *s: rng.normal(0, 0.5, s).astype(np.float64)
    return li.BiGRU(["a", "b", "c"], [f(256, 3 * hidden) for _ in range(2)], [f(hidden, 3 * hidden) for _ in range(2)], f(2 * hidden, 3), f(3), span=8, margin=2)


def test_gradients_equal_differences():
    m = tiny()
    rng = np.random.default_rng(1)
    x, y, mask = rng.integers(1, 256, (5, 4)), rng.integers(0, 3, 4), np.ones((5, 4))
    mask[3:, 0] = 0
    _, grads = m.gradients(x, y, mask)
    for p, g in zip(m.parameters(), grads, strict=True):
        for at in [tuple(rng.integers(0, s) for s in p.shape) for _ in range(6)] + ([(int(x[0, 0]), 0)] if p.shape[0] == 256 else []):
            keep, e = p[at], 1e-4
            p[at] = keep + e
            up = m.gradients(x, y, mask)[0]
            p[at] = keep - e
            down = m.gradients(x, y, mask)[0]
            p[at] = keep
            assert abs((up - down) / (2 * e) - g[at]) < 1e-3


def test_every_byte_counts_once():
    m = tiny(2)
    for n in (1, 7, 8, 9, 40, 1000):
        data = bytes(np.random.default_rng(n).integers(1, 256, n, dtype=np.uint8))
        want = np.zeros(3)
        for a in range(0, n, m.span):
            padded = np.zeros(m.span + 2 * m.margin, np.uint8)
            for j in range(a - m.margin, a + m.span + m.margin):
                if 0 <= j < n:
                    padded[j - a + m.margin] = data[j]
            p = m.probabilities(padded[:, None])[m.margin : m.margin + min(m.span, n - a), 0]
            want += p.sum(axis=0)
        for block in (2, 64):
            assert np.allclose(m.pooled([data, b"", data[:3]], block)[0], want / want.sum(), atol=1e-3)


LANGS = {"xx": "katoli menora sutipe ", "yy": "zwrst brunk gleft schlomp "}


def rows(n):
    import random

    rnd = random.Random(4)
    return [(i, " ".join(rnd.choice(LANGS[k].split()) for _ in range(30)), k) for i, k in ((i, "xx" if i % 2 else "yy") for i in range(n))]


def test_learns_two_languages(spark):
    df = spark.createDataFrame(rows(80), "doc_id long, text string, lang string")
    model = li.fit(df)
    got = {r.doc_id: r for r in li.predict(df, model).collect()}
    assert all(got[i]._li_lang == k for i, _, k in rows(80)) and all(0 <= r._li_score <= 1 for r in got.values())
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (None, "katoli"), (4, "katoli")], "doc_id long, text string")
    assert [r._li_lang for r in li.predict(odd, model).collect()][:3] == ["und"] * 3


def test_training_never_sees_what_is_held_out(spark):
    df = spark.createDataFrame(rows(200), "doc_id long, text string, lang string")
    marked = {r.doc_id: r.h for r in df.select("doc_id", li.held_out().alias("h")).collect()}
    assert marked == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(200)}
    only = df.where(li.held_out())
    assert li.fit(only) is None
    assert {r._li_lang for r in li.predict(only, None).collect()} == {"und"}


def test_messy_and_empty(spark, messy, messy_rows, nothing):
    model = li.fit(messy)
    assert li.predict(messy, model).count() == len(messy_rows) and set(messy.columns) < set(li.predict(messy, model).columns)
    assert li.predict(nothing, model).count() == 0 and li.fit(nothing) is None


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = li.predict(docs, li.fit(docs)).where(li.held_out() & docs["text"].isNotNull())
    good = out.where("lang = _li_lang").count()
    assert good >= 0.97 * out.count()
