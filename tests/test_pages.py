import hypothesis.strategies as st
import pytest
from hypothesis import HealthCheck, given, settings
from pyspark.sql import functions as F

from folioscope.operators import merge
from folioscope.operators import pages as pg


def greedy(sizes, limit):
    bins, held, total, n = [], 0, 0, 0
    for s in sizes:
        if held and total + s > limit:
            n, held, total = n + 1, 0, 0
        held, total = held + 1, total + s
        bins.append(n)
    return bins


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(0, 12), max_size=12), min_size=1, max_size=20))
def test_packing_is_greedy(spark, groups):
    df = spark.createDataFrame([(i, g) for i, g in enumerate(groups)], "i int, sizes array<bigint>")
    got = {r["i"]: r["b"] for r in df.select("i", pg.pack(F.col("sizes"), 10).alias("b")).collect()}
    for i, g in enumerate(groups):
        assert got[i] == greedy(g, 10)


def test_packing_edges(spark):
    df = spark.createDataFrame([([4, 5, 6, 20, 1],), ([10],), ([5, 5],), ([0, 11],), ([],)], "sizes array<bigint>")
    assert [r[0] for r in df.select(pg.pack(F.col("sizes"), 10)).collect()] == [[0, 0, 1, 2, 3], [0], [0, 0], [0, 1], []]


def test_batches_start_anew_in_each_chunk(spark):
    df = spark.range(7).select(F.col("id").alias("page_no"))
    got = [(r.chunk_id, r.batch_id) for r in pg.with_chunks(df, 5, 2).orderBy("page_no").collect()]
    assert got == [(0, 0), (0, 0), (0, 1), (0, 1), (0, 2), (1, 0), (1, 0)]
    for bad in ((0, 1), (1, 0)):
        with pytest.raises(ValueError):
            pg.with_chunks(df, *bad)


def test_positional_join_keeps_every_page(spark):
    pages = spark.createDataFrame([("d", 0, 10), ("d", 1, 11), ("e", 0, 12)], "doc string, pos int, page_no int")
    results = spark.createDataFrame([("d", 0, "x"), ("e", 0, None), ("e", 1, "surplus")], "doc string, pos int, text string")
    got = {r.page_no: (r.ok, r.text) for r in pg.positional_left_join(pages, results, ["doc"]).collect()}
    assert got == {10: (True, "x"), 11: (False, ""), 12: (True, "")}


def test_joining_by_chunks_or_at_once_is_the_same(spark):
    rows = [("d", i, None if i == 3 else f"t{i}") for i in range(9)]
    pages = spark.createDataFrame(rows, "doc string, page_no int, text string")
    chunks = pg.ordered_text(pg.with_chunks(pages, 4, 2), ["doc", "chunk_id"], "page_no", "text", "\n\n")
    twice = pg.ordered_text(chunks, ["doc"], "chunk_id", "text", "\n\n").first().text
    assert twice == pg.document_texts(pages, ["doc"]).first().text == "\n\n".join(t or "" for _, _, t in rows)


def test_loss(spark):
    rows = [("a", i, i % 2 == 0) for i in range(80)] + [("b", 0, True)]
    got = {r.doc: r for r in pg.loss_summary(spark.createDataFrame(rows, "doc string, page_no int, ok boolean"), ["doc"], max_failed=39).collect()}
    assert (got["a"].n_pages, got["a"].n_ok, got["a"].n_failed, got["a"].status) == (80, 40, 40, "failed")
    assert got["a"].failed_pages == list(range(2, 62, 2)) and got["b"].status == "ocr_done"


def test_merging_keeps_every_leaf(spark):
    rows = [(n, i, f"<{i}>".encode()) for n in range(1, 101) for i in range(n)]
    df = spark.createDataFrame(rows, "doc int, ix int, content binary")
    for r in merge.merge_tree(df, "doc", "ix", "content").collect():
        assert bytes(r.content).decode() == "".join(f"<{i}>" for i in range(r.doc))
    with pytest.raises(ValueError):
        merge.merge_tree(df, "doc", "ix", "content", fan_in=1)
    assert merge.merge_tree(df.limit(0), "doc", "ix", "content").count() == 0
