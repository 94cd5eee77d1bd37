"""Streaming ingestion: new documents in, results and status rows out.

At-least-once input becomes idempotent output: a micro-batch writes under its
batch id, and status rows carry (key, batch_id), so a repeated batch overwrites
what it wrote before. One failed document never stops the others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioscope.functions.text import stem
from folioscope.shipping import ship

STATUS = "system_key string, status string, error_message string"


def event_rows(events: DataFrame) -> DataFrame:
    """(key, bucket_id, request_id) of object-created events(messages, request_id): one row per message; a message without object_id has none."""
    out = events.select("request_id", F.explode("messages").alias("m"))
    return out.select(F.col("m.details.object_id").alias("key"), F.col("m.details.bucket_id").alias("bucket_id"), "request_id").where("key is not null")


def wanted(keys: DataFrame, prefix: str, key: str = "key") -> DataFrame:
    """Keys under the input prefix; an empty prefix passes all."""
    return keys.where(F.startswith(F.col(key), F.lit(prefix))) if prefix else keys


def status_rows(keys: DataFrame, status: Column, error: Column | None = None, *kept: str) -> DataFrame:
    none = F.lit(None).cast("string")
    return keys.select(F.col("key").alias("system_key"), status.alias("status"), F.left(none if error is None else error, F.lit(1000)).alias("error_message"), *kept)


def transitions(outcome: DataFrame, *ids: str) -> DataFrame:
    """Both status rows of each row of outcome(key, error, ids): processing, then done or failed with the error."""
    both = outcome.withColumn("step", F.explode(F.array(F.lit(0), F.lit(1))))
    end = F.when(F.col("error").isNull(), "ocr_done").otherwise("failed")
    return status_rows(both, F.when(F.col("step") == 0, "ocr_processing").otherwise(end), F.when(F.col("step") == 1, F.col("error")), *ids, "step")


def latest_status(statuses: DataFrame, *ids: str) -> DataFrame:
    """The last status by (batch_id, step) of each key; with ids, which tell runs of one key apart, of each run."""
    last = F.max(F.struct("batch_id", "step", "status", "error_message")).alias("x")
    return statuses.groupBy(*ids, "system_key").agg(last).select("system_key", "x.status", "x.error_message", *ids)


def send_statuses(statuses: DataFrame, make_sender: Callable[[], Callable[[dict], int]]) -> DataFrame:
    """(system_key, status, sent, problem): each row handed to a sender, which returns an HTTP status.

    A failure is a row, never an error: the status table stays the record. The
    sender is made once per task and should give up by itself (10 s is usual).
    """
    ship(statuses.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        send = make_sender()
        for b in batches:
            out = []
            for row in b.astype(object).where(b.notna(), None).to_dict("records"):
                try:
                    code = send(row)
                    out.append((row["system_key"], row["status"], code < 400, None if code < 400 else f"HTTP {code}"))
                except Exception as e:  # noqa: BLE001
                    out.append((row["system_key"], row["status"], False, str(e)[:300]))
            yield pd.DataFrame(out, columns=["system_key", "status", "sent", "problem"])

    return statuses.select("system_key", "status", "error_message").mapInPandas(run, "system_key string, status string, sent boolean, problem string")


def run_ingest(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    process: Callable[[DataFrame], DataFrame],
    prefix: str = "",
    glob: str = "*",
) -> StreamingQuery:
    """Watches a folder of documents and runs process(documents) on each micro-batch of new ones.

    documents: (key, stem, content). process returns (key, text, error), a row per document. Results go to
    target/results/batch_id=N, statuses to target/status/batch_id=N.
    """
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    files = (
        spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(source)
    )
    root = source.rstrip("/")
    key = F.regexp_replace(F.col("path"), f"^(file:/*)?/?\\Q{root.lstrip('/')}/\\E", "")
    documents = wanted(files.select(key.alias("key"), stem(key).alias("stem"), "content"), prefix)

    def handle(batch: DataFrame, batch_id: int) -> None:
        out = f"{target}/results/batch_id={batch_id}"
        process(batch).write.mode("overwrite").parquet(out)  # a document is processed once, statuses read what was written
        done = spark.read.parquet(out)
        transitions(done.select("key", "error")).write.mode("overwrite").parquet(f"{target}/status/batch_id={batch_id}")

    return documents.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, width: str = "1 hour", lateness: str = "1 hour") -> DataFrame:
    """An extension: events per type and time window. Works on streams and tables alike."""
    stamped = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if events.isStreaming:
        stamped = stamped.withWatermark("ts", lateness)
    out = stamped.groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("window_start"), "event_type", "n", "total")
