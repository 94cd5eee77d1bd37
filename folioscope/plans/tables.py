"""How the test tables stand in for documents, pages, questions and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions.text import pytrim


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page rows (doc, page_no, role, text): a conversation is a document, a turn a page."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("doc"), F.col("turn").alias("page_no"), "role", "text"
    )


def indexed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc, page from 1, text) without blank pages, as they go into an index."""
    p = pages(spark, sf_dir)
    return p.select("doc", (F.col("page_no") + 1).alias("page"), pytrim(F.coalesce("text", F.lit(""))).alias("text")).where("text <> ''")


def answer_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc, page_no, reference, hypothesis): each turn and the next."""
    p = pages(spark, sf_dir)
    later = p.select("doc", (F.col("page_no") - 1).alias("page_no"), F.col("text").alias("hypothesis"))
    return p.select("doc", "page_no", F.col("text").alias("reference")).join(later, ["doc", "page_no"])
