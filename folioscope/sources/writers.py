"""Sinks: result documents, chunk lines, manifests, registries, answers, metric reports.

Spark's committer gives what temporary files and moves are used for elsewhere: a
result is there in full or not at all. Ordered single-file outputs are written
from one row, which holds one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.functions.metrics import METRICS, mean_metrics
from folioscope.operators.pages import document_json, document_texts


def write_lines(df: DataFrame, line, path: str, mode: str = "overwrite") -> None:
    df.select(line.alias("value")).write.mode(mode).text(path)


def write_results(pages: DataFrame, keys: list[str], path: str) -> None:
    """text/ and json/ below path, partitioned by document: one line of JSON, one text, per document."""
    document_texts(pages, keys).write.mode("overwrite").partitionBy(*keys).parquet(f"{path}/text")
    document_json(pages, keys).select(*keys, F.to_json("result").alias("value")).write.mode("overwrite").partitionBy(*keys).text(f"{path}/json")


def write_chunk_lines(bodies: DataFrame, path: str) -> None:
    """{"body": ...} per line, other scripts unescaped."""
    write_lines(bodies, F.to_json(F.struct("body")), path)


def write_chunk_table(bodies: DataFrame, path: str, mode: str = "overwrite") -> None:
    bodies.write.mode(mode).parquet(path)


def manifest_rows(uploads: DataFrame, dataset_dir: str) -> DataFrame:
    """One manifest row of uploads(source_file, upload_name, file_id, chunks_count), sorted by source file."""
    item = F.struct("source_file", "upload_name", "file_id", F.col("chunks_count").cast("int").alias("chunks_count"))
    return uploads.agg(F.array_sort(F.collect_list(item)).alias("files")).select(F.lit(dataset_dir).alias("dataset_dir"), "files")


def write_manifest(uploads: DataFrame, dataset_dir: str, path: str) -> None:
    manifest_rows(uploads, dataset_dir).write.mode("overwrite").json(path)


def append_registry(record: DataFrame, path: str) -> None:
    """Appends records(ord, ...) to a registry table; ord keeps the order that last-wins lookups need."""
    record.write.mode("append").parquet(path)


def write_answers(answered: DataFrame, path: str) -> None:
    answered.write.mode("overwrite").json(path)


def metric_report(rows: DataFrame) -> DataFrame:
    """One row: rows and mean_metrics. Missing metrics are JSON nulls; metrics without any value have no mean."""
    means = mean_metrics(rows).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "mean")))).alias("mean_metrics"))
    names = ["question", "correct_answer", "model_answer", "status", *METRICS, "metrics_error"]
    return rows.agg(F.collect_list(F.struct(*names)).alias("rows")).crossJoin(means)  # one row each


def write_report(rows: DataFrame, path: str) -> None:
    """json/ with the report and csv/ with the rows."""
    metric_report(rows).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/json")
    rows.write.mode("overwrite").option("header", "true").option("quote", '"').option("escape", '"').csv(f"{path}/csv")
