import pytest

cp = pytest.importorskip("corpus_pipeline")


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    assert [n for n, _ in cp.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontaminate", "pieces"]
    for name, stage in cp.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema)
        assert docs.columns == columns and 0 < docs.count() <= before
        assert docs.groupBy("doc_id").count().where("count > 1").count() == 0
        before = docs.count()
    last = cp.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == before and last.where("not lossless").count() == 0
    assert {r.doc_id for r in cp.run(spark, sf_dir).collect()} == {r.doc_id for r in docs.collect()}


def test_decisions_take_effect(spark, sf_dir):
    import re

    run = {n: f for n, f in cp.STAGES}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = [re.sub(r"\s+", " ", r.text.lower()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    left = run["decontaminate"](spark, docs, sf_dir).collect()
    assert not any(b in re.sub(r"\s+", " ", r.text.lower()) for r in left for b in bench)
    sizes = {r.doc_id: r.n_chars for r in run["line_dedup"](spark, docs, sf_dir).collect()}
    assert all(n is not None for n in sizes.values())


@pytest.mark.parametrize("empty", ["documents", "labels", "benchmark"])
def test_empty_tables(spark, sf_dir, tmp_path, empty):
    for t in ("documents", "labels", "benchmark"):
        df = spark.read.parquet(f"{sf_dir}/{t}.parquet")
        (df.limit(0) if t == empty else df).write.parquet(str(tmp_path / f"{t}.parquet"))
    out = cp.run(spark, str(tmp_path))
    assert (out.count() == 0) == (empty == "documents")
