import numpy as np
import pytest
from oracle import rows_of, rows_of_sql
from pyspark.sql import functions as F

from folioscope.operators import retrieval as rt
from folioscope.plans import catalogue


def test_topk_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    m = rng.normal(size=(60, 8)).astype(np.float32)
    m[7] = m[3]  # a tie
    m[9] = 0
    rows = [(i, v.tolist()) for i, v in enumerate(m)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>").union(spark.createDataFrame([(99, None)], "vec_id long, embedding array<float>"))
    q = v.where("vec_id < 5").withColumnRenamed("vec_id", "query_id")
    got = {}
    for r in rt.topk_cosine(q, v, k=6, block=2).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    norm = m.astype(np.float64) / np.maximum(np.linalg.norm(m.astype(np.float64), axis=1, keepdims=True), 1e-30)
    for i in range(5):
        s = np.round(norm @ norm[i], 6)
        want = [j for j in sorted(range(60), key=lambda j: (-s[j], j)) if s[j] >= 0 and j != 9][:6]
        assert [(a, b) for a, b, _ in sorted(got[i])] == list(enumerate(want, 1))
    assert rt.topk_cosine(q.limit(0), v).count() == 0


def test_ranking_drops_null_and_low_scores(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", -0.5), (1, "c", 0.0), (1, "d", 0.9), (1, "e", 0.9)], "q int, id string, score double")
    assert [(r["rank"], r.id) for r in rt.rank_hits(df, "q", "score", ["id"], k=2).orderBy("rank").collect()] == [(1, "d"), (2, "e")]


def test_context_and_answers(spark):
    hits = spark.createDataFrame([(1, 2, 0.5, "f2", None), (1, 1, 0.98765, "f1", "text")], "query_id int, rank int, score double, filename string, text string")
    ctx = rt.contexts(hits, "query_id")
    assert ctx.first().context == "Источник 1 (score=0.9877, файл=f1):\ntext\n\nИсточник 2 (score=0.5000, файл=f2):\n"
    q = spark.createDataFrame([(1, "one"), (2, "two")], "query_id int, question string")
    got = {r.query_id: r.model_answer for r in rt.answers(q, ctx, lambda question, context: F.concat(question, F.lit("!"))).collect()}
    assert got == {1: "one!", 2: rt.NO_HITS}


def test_context_scores_are_rounded_from_their_binary_value(spark, duck):
    scores = [0.39215, 0.39225, 0.38835, 0.03125, 0.09375, 0.99995, 0.00005, 2.5, 0.0, -0.00001, 1e12 + 0.03125, 1e23, *np.round(np.random.default_rng(2).random(300), 5).tolist()]
    hits = spark.createDataFrame([(1, i, s, "f", "t") for i, s in enumerate(scores, 1)] + [(2, 1, None, "f", "t")], "query_id int, rank int, score double, filename string, text string")
    got = {r.query_id: r.context for r in rt.contexts(hits, "query_id").collect()}
    assert got[1].split("\n\n") == [f"Источник {i} (score={s:.4f}, файл=f):\nt" for i, s in enumerate(scores, 1)]
    assert [duck.execute("SELECT printf('%.4f', CAST(? AS DOUBLE))", [s]).fetchone()[0] for s in scores] == [f"{s:.4f}" for s in scores]
    assert got[2] == "Источник 1 (score=null, файл=f):\nt"


def test_context_block_on_scores_that_end_in_a_five(spark, duck, tmp_path):
    rows = [(0, [1.0, 0.0])] + [(i, [s, (1 - s * s) ** 0.5]) for i, s in enumerate([0.39215, 0.38835, 0.61945, 0.70175, 0.15005], 1)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duck.cursor()
    con.execute(f"CREATE TEMP VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert rows_of(catalogue.QUERIES["context_block"](spark, str(tmp_path))) == rows_of_sql(con, catalogue.SQL["context_block"])


def test_lookup_precedence(spark):
    reg = spark.createDataFrame([(0, "n", "d", "old"), (1, "n", "d", "new"), (2, "m", "e", "other")], "ord int, name string, dataset_dir string, vector_store_id string")
    assert rt.resolve_index(reg, index_id="given", name="n") == "given"
    assert rt.resolve_index(reg, name="n", dataset="e") == "new"
    assert rt.resolve_index(reg, dataset="e") == "other"
    for bad in ({"name": "zzz"}, {}):
        with pytest.raises(ValueError):
            rt.resolve_index(reg, **bad)
    assert rt.name_map(reg, "name", "vector_store_id", "ord").first().names == {"m": "other", "n": "new"}
    rt.one_selector("a", None, "")
    with pytest.raises(ValueError):
        rt.one_selector("a", "b")


def test_hit_text(spark):
    df = spark.createDataFrame([(1, [("x",)]), (2, []), (3, None)], "i int, content array<struct<text:string>>")
    assert [r[0] for r in df.orderBy("i").select(rt.hit_text(F.col("content"))).collect()] == ["x", "", ""]


def test_topk_of_mixed_dimensions_nulls_and_many_blocks(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in rng.integers(-2, 3, 2 + i % 2)]) for i in range(60)] + [(900, None), (901, []), (902, [1.0, None]), (903, [0.0, 0.0])]
    queries = [(1, None), (2, [1.0, 2.0, 0.5]), (3, [1.0, 0.5]), (4, [0.0, 0.0]), (5, [None, 1.0]), *[(10 + i, v) for i, (_, v) in enumerate(vectors[:20])], (99, [1.0] * 7)]
    want = {}
    for q, a in queries:
        if a and None not in a and any(a):
            scored = [(round(float(np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b)), 6), v) for v, b in vectors if b and None not in b and any(b) and len(b) == len(a)]
            for rank, (s, v) in enumerate(sorted((x for x in scored if x[0] >= 0), key=lambda x: (-x[0], x[1]))[:4], 1):
                want[q, rank] = (v, s)
    df = lambda rows, name: spark.createDataFrame(rows, f"{name} long, embedding array<double>")
    for block in (3, 2048):
        got = rt.topk_cosine(df(queries, "query_id"), df(vectors, "vec_id"), 4, block=block).collect()
        assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got} == want
    assert rt.topk_cosine(df(queries[:1], "query_id"), df(vectors, "vec_id")).count() == 0
