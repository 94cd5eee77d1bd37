"""Readers: result documents, manifests, registries, question sets, binary documents, keys.

Untrusted JSON is read as VARIANT, so one bad element doesn't take its
neighbours with it; a bad file raises, unless bad files are asked for as rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions.text import page_number, pytrim, strip_prefix
from folioscope.operators.pages import pages_grouped
from folioscope.shipping import ship

MANIFEST = "dataset_dir string, files array<struct<source_file:string,upload_name:string,file_id:string,chunks_count:int>>"
REGISTRY = "dataset_dir string, manifest string, name string, vector_store_id string, status string"


def binary_documents(spark: SparkSession, path: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """(path, modificationTime, length, content) of files."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).load(path)


def json_texts(spark: SparkSession, path: str) -> DataFrame:
    """(file, body) of all *.json files below path, sorted by path components."""
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(path, wholetext=True)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("body")).orderBy(F.split("file", "/"))


def result_items(texts: DataFrame, strict: bool = True) -> DataFrame:
    """(file, pos, page, text) of texts(file, body): elements of data that are objects with a page that reads as an integer.

    A body that isn't an object with a list `data` raises, or with strict=False gives no rows.
    """
    data = F.try_variant_get(F.try_parse_json("body"), "$.data", "array<variant>")
    if strict:
        data = F.when(data.isNull(), F.raise_error(F.concat(F.lit("unexpected format: "), F.col("file")))).otherwise(data)
    items = texts.select("file", F.posexplode(data).alias("pos", "item"))
    kept = items.where(F.schema_of_variant("item").startswith("OBJECT"))
    value = F.try_variant_get("item", "$.text", "variant")
    # text is `str(x or "")`: JSON null, false, 0 and empty values count as empty
    plain = F.coalesce(F.try_variant_get("item", "$.text", "string"), F.lit(""))
    empty = value.isNull() | F.is_variant_null(value) | plain.isin("false", "0", "[]", "{}") & (F.schema_of_variant(value) != "STRING")
    out = kept.select("file", "pos", page_number(F.try_variant_get("item", "$.page", "variant")).alias("page"), F.when(empty, "").otherwise(plain).alias("text"))
    return out.where("page is not null")


def result_pages(texts: DataFrame, strict: bool = True) -> DataFrame:
    """(file, page, text): items grouped by page."""
    return pages_grouped(result_items(texts, strict), ["file"])


def _json_array(spark: SparkSession, path: str, what: str) -> DataFrame:
    body = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    items = F.try_variant_get("v", "$", "array<variant>")
    return body.select(F.posexplode(F.when(items.isNull(), F.raise_error(F.lit(f"{what}: a JSON array is expected"))).otherwise(items)).alias("ord", "item"))


def questions(spark: SparkSession, path: str) -> DataFrame:
    """(ord, question, answer) of a question set; an element that isn't an object with a question raises."""
    rows = _json_array(spark, path, "questions")
    asked = F.try_variant_get("item", "$.question", "string")
    bad = F.raise_error(F.concat(F.lit("no question in element "), (F.col("ord") + 1).cast("string")))
    return rows.select("ord", F.when(asked.isNull(), bad).otherwise(asked).alias("question"), F.try_variant_get("item", "$.answer", "string").alias("answer"))


def answered_questions(spark: SparkSession, path: str) -> DataFrame:
    """(ord, question, answer, correct_answer, model_answer, status, error, stderr)."""
    rows = _json_array(spark, path, "answered questions")
    names = ["question", "answer", "correct_answer", "model_answer", "status", "error", "stderr"]
    return rows.select("ord", *[F.try_variant_get("item", f"$.{n}", "string").alias(n) for n in names])


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def manifest(spark: SparkSession, path: str, required: bool = False) -> DataFrame:
    """Upload manifest; a missing one is empty, or an error if required."""
    if not _exists(spark, path):
        if required:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(path, multiLine=True)


def file_ids(found: DataFrame) -> DataFrame:
    """Non-empty file ids of a manifest."""
    return found.select(F.explode("files").alias("f")).select("f.file_id").where(F.nullif("file_id", F.lit("")).isNotNull())


def registry(spark: SparkSession, path: str) -> DataFrame:
    """(ord, ...) records of an index registry in order; a missing file is an empty registry."""
    if not _exists(spark, path):
        return spark.createDataFrame([], f"ord int, {REGISTRY}")
    rows = _json_array(spark, path, "registry")
    names = [f.split()[0] for f in REGISTRY.split(", ")]
    return rows.select("ord", *[F.try_variant_get("item", f"$.{n}", "string").alias(n) for n in names])


def json_line_rows(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Good lines (file, value as variant) and bad lines (file, line of at most 200 characters) of JSONL files. Blank lines are neither."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line")).where(pytrim(F.col("line")) != "")
    parsed = lines.withColumn("value", F.try_parse_json("line"))
    return parsed.where("value is not null").select("file", "value"), parsed.where("value is null").select("file", F.left("line", F.lit(200)).alias("line"))


def resolve_keys(keys: DataFrame, listing: DataFrame, prefix: str) -> DataFrame:
    """keys(key) with path: the key itself if listed, else the key without prefix if that is listed, else null."""
    listed = listing.select(F.col("path").alias("_p")).distinct()
    out = keys.join(listed, keys["key"] == listed["_p"], "left").withColumnRenamed("_p", "_exact").withColumn("_bare", strip_prefix(F.col("key"), prefix))
    out = out.join(listed, out["_bare"] == listed["_p"], "left")
    return out.withColumn("path", F.coalesce("_exact", "_p")).drop("_exact", "_bare", "_p")


def page_scan(documents: DataFrame, splitter: Callable[[bytes], list[bytes]]) -> DataFrame:
    """(path, page_no, content) of documents(path, content). splitter: bytes of a document to bytes of its pages."""

    ship()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"], strict=True):
                pages = splitter(bytes(content))
                yield pd.DataFrame({"path": [path] * len(pages), "page_no": range(len(pages)), "content": pages})

    return documents.select("path", "content").mapInPandas(run, "path string, page_no int, content binary")
