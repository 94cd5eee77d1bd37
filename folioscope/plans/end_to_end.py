"""The three dataflows: documents to results, results to an index, questions to a metric report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.config import Settings
from folioscope.functions import metrics
from folioscope.functions.encoders import hashed_words, scorers
from folioscope.operators import chunking, recognition, remote, retrieval
from folioscope.operators import pages as pg
from folioscope.operators.merge import concat_fragments


def recognise_documents(
    pages: DataFrame,
    make_transport: remote.Transport,
    store: str,
    settings: Settings | None = None,
    payload: Callable[[Column], Column] = concat_fragments,
) -> tuple[DataFrame, DataFrame]:
    """Page rows (doc, page_no, ok, text, blocks, dims) and outcomes (doc, counts, failed_pages, status, error).

    pages(doc, page_no, content). Pages are dealt in chunks and batches, packed by
    bytes, sent as requests, and answers joined back by position. Replies are
    written to `store` before they are used, so that no call is made twice by
    a plan that is evaluated twice. A refused key fails its whole document; any other failure
    costs the pages of its request.
    """
    settings = settings or Settings()
    batch = ["doc", "chunk_id", "batch_id"]
    request = [*batch, "sub_id"]
    dealt = pg.with_chunks(pages, settings.ocr_chunk_size, settings.ocr_batch_size).withColumn("bytes", F.octet_length("content").cast("bigint"))
    packed = pg.with_sub_batches(dealt, batch, "page_no", "bytes", settings.ocr_max_batch_bytes)
    parts = F.array_sort(F.collect_list(F.struct("page_no", "content")))
    sent = packed.groupBy(*request).agg(parts.alias("parts"))
    requests = sent.select(*request, payload(F.transform("parts", lambda x: x["content"])).alias("payload")).withColumn("request", F.sha2("payload", 256))
    calls = remote.CallPolicy(submit_rate=settings.ocr_submit_rps, poll_rate=settings.ocr_poll_rps)
    remote.recognise(requests, make_transport, request, calls, settings.tasks).write.mode("overwrite").parquet(store)
    replies = pages.sparkSession.read.parquet(store)
    parsed = recognition.parse_pages(replies.where("ok").select(*request, recognition.combine_lines(F.col("body")).alias("response")))
    places = sent.select(*request, F.posexplode(F.transform("parts", lambda x: x["page_no"])).alias("pos", "page_no"))
    joined = places.join(parsed.withColumnRenamed("text", "_t"), [*request, "pos"], "left")
    rows = joined.select("doc", "page_no", F.col("_t").isNotNull().alias("ok"), F.coalesce("_t", F.lit("")).alias("text"), "blocks", "dims")
    refused = replies.where("error_kind = 'auth'").groupBy("doc").agg(F.min("error").alias("refusal"))
    outcome = pg.loss_summary(rows, ["doc"], settings.ocr_max_failed_pages).join(refused, "doc", "left")
    lost = F.format_string("%d of %d pages lost, first: %s", "n_failed", "n_pages", F.to_json("failed_pages"))
    outcome = outcome.withColumns(
        {
            "status": F.when(F.col("refusal").isNotNull(), "failed").otherwise(F.col("status")),
            "error": F.coalesce("refusal", F.when(F.col("status") == "failed", lost)),
        }
    ).drop("refusal")
    return rows, outcome


def build_index(pages: DataFrame, keys: list[str], encoder: Callable[[Column], Column] = hashed_words, window: int = 400, overlap: int = 50) -> DataFrame:
    """(keys, chunk_ix, body, embedding) of pages(keys, page, text): the chunk table that is searched."""
    bodies = chunking.chunk_bodies(chunking.marked_text(pages, keys), keys, window, overlap)
    return bodies.select(*keys, "chunk_ix", "body", encoder(F.col("body")).alias("embedding"))


def answer_questions(
    questions: DataFrame,
    index: DataFrame,
    generator: Callable[[Column, Column], Column],
    filename: str,
    encoder: Callable[[Column], Column] = hashed_words,
    k: int = 10,
    threshold: float = 0.0,
) -> DataFrame:
    """questions(query_id, question) with context, model_answer and status, from an index of build_index."""
    vectors = index.where("embedding is not null").withColumn("vec_id", F.xxhash64(filename, "chunk_ix"))
    asked = questions.select("query_id", encoder(F.col("question")).alias("embedding")).where("embedding is not null")
    hits = retrieval.topk_cosine(asked, vectors, k, threshold)
    found = hits.join(vectors.select("vec_id", F.col(filename).cast("string").alias("filename"), F.col("body").alias("text")), "vec_id")
    return retrieval.answers(questions, retrieval.contexts(found, "query_id"), generator)


def evaluate(answered: DataFrame, model_scores: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Metric rows of answered questions, and the means of the metrics that have values. Model-based ones use the stand-ins, unless given."""
    rows = metrics.score_answers(answered, scorers() if model_scores is None else model_scores)
    return rows, metrics.mean_metrics(rows)
