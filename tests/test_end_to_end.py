import json
import logging

from pyspark.sql import functions as F

from folioscope.config import Settings
from folioscope.operators import remote, retrieval
from folioscope.plans import end_to_end as e2e
from folioscope.streaming import ingest
from folioscope.streaming.progress import JsonProgress


def formfeed(parts):
    return F.array_join(F.transform(parts, lambda p: F.decode(p, "utf-8")), "\f").cast("binary")


def test_documents_to_results(spark, tmp_path):
    class Picky(remote.EchoTransport):
        def submit(self, key, payload):
            if b"secret" in payload:
                return remote.Reply(401, "refused")
            if b"lost" in payload:
                return remote.Reply(400)
            return super().submit(key, payload)

    rows = [("good", i, f"text {i}".encode()) for i in range(23)]
    rows += [("part", i, (b"lost" if i == 5 else b"x" * 30)) for i in range(8)] + [("key", 0, b"fine"), ("key", 1, b"secret " * 9)]
    pages = spark.createDataFrame(rows, "doc string, page_no int, content binary")
    settings = Settings(ocr_chunk_size=10, ocr_batch_size=4, ocr_max_batch_bytes=60)
    got, outcome = e2e.recognise_documents(pages, Picky, str(tmp_path / "replies"), settings, formfeed)
    texts = {(r.doc, r.page_no): (r.ok, r.text) for r in got.collect()}
    assert len(texts) == len(rows) and all(texts["good", i] == (True, f"text {i}") for i in range(23))
    state = {r.doc: r for r in outcome.collect()}
    assert state["good"].status == "ocr_done" and state["good"].error is None and state["good"].n_ok == 23
    assert state["part"].status == "failed" and 6 in state["part"].failed_pages and state["part"].error.startswith(f"{state['part'].n_failed} of 8")
    assert state["key"].status == "failed" and "refused" in state["key"].error
    assert all(r.n_ok + r.n_failed == r.n_pages for r in state.values())


def test_results_to_answers_to_report(spark):
    pages = spark.createDataFrame([("a", 1, "cats purr softly at night"), ("b", 1, "rockets burn kerosene and oxygen"), ("b", 2, "engines are loud")], "doc string, page int, text string")
    index = e2e.build_index(pages, ["doc"])
    q = spark.createDataFrame([(1, "do cats purr at night", "at night"), (2, "kerosene rockets", "oxygen"), (3, "???", "none")], "query_id int, question string, answer string")
    first = lambda question, context: F.regexp_extract(context, "файл=(\\w+)", 1)
    answered = e2e.answer_questions(q, index, first, "doc", k=1)
    assert {r.query_id: r.model_answer for r in answered.collect()} == {1: "a", 2: "b", 3: retrieval.NO_HITS}
    rows, means = e2e.evaluate(answered, {"semantic_similarity": lambda a, b: 0.25})
    assert rows.count() == 3 and {r.metric: r["mean"] for r in means.collect()}["semantic_similarity"] == 0.25


def test_status_callbacks_never_stop_the_job(spark):
    rows = spark.createDataFrame([("a", "ocr_done", None), ("b", "failed", "why"), ("c", "failed", None)], ingest.STATUS)

    def make():
        def send(row):
            if row["system_key"] == "c":
                raise TimeoutError("late")
            return 200 if row["error_message"] is None else 500

        return send

    got = {r.system_key: (r.sent, r.problem) for r in ingest.send_statuses(rows, make).collect()}
    assert got == {"a": (True, None), "b": (False, "HTTP 500"), "c": (False, "late")}


def test_helpers(spark):
    assert json.loads(Settings().to_json())["ocr_dpi"] == 100
    df = spark.createDataFrame([("in_progress",), ("completed",), ("failed",)], "s string")
    assert df.where(retrieval.terminal(F.col("s"))).count() == 2
    assert retrieval.require_rows(df, "rows") is df
    try:
        retrieval.require_rows(df.limit(0), "files")
        raise AssertionError
    except ValueError as e:
        assert str(e) == "no files"


def test_progress_lines(spark, tmp_path, caplog):
    listener = JsonProgress(logging.getLogger("test.progress"))
    with caplog.at_level(logging.INFO, "test.progress"):
        listener._say("progress", query="q", batch=3)
    assert json.loads(caplog.records[0].message) == {"event": "progress", "query": "q", "batch": 3}
