"""The training-corpus pipeline: five stages over documents, each on all that the one before kept.

toxicity        documents that the ordinal model grades above clean go
line_dedup      repeated lines go; a document that loses every line goes with them
near_dedup      one document of each near-duplicate group stays, the smallest id
decontaminate   documents that hold a benchmark item go
pieces          what is left becomes SentencePiece ids

All stages but the last return the columns of documents. A stage's result is
written as Parquet and read again, which cuts lineage and lets a lost executor
cost no more than its own stage.

Defined cases: rows with null or empty texts aren't toxic, have no lines that could go, are linked with
nothing, and end with no pieces; rows that share doc_id and text are kept or
dropped together, up to near_dedup, which keeps them if it keeps their id; a null doc_id is one more id, the
smallest; rows of `labels` without doc_id or label, and of `benchmark` without
item_id, are ignored; columns beside doc_id and text pass through, save n_chars, which follows
the text; an empty documents table gives an empty result, and empty labels or an empty benchmark
reject nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm import decontaminate, line_dedup, near_dup, pieces, toxicity
from folioscope.llm.common import Work


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(docs).where("not _ld_empty")
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def _near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Similarity 0.8, that of stages on word shingles; with t = 32 a pair at the threshold is missed with a chance of 2e-8.
    return near_dup.keep_one(docs, percent=80, t=32)


def _decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    flagged = decontaminate.flag(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return flagged.where("_dc_item is null").select(*docs.columns)


def _pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.round_trip(docs, pieces.default_model())


STAGES = [
    ("toxicity", _toxicity),
    ("line_dedup", _line_dedup),
    ("near_dedup", _near_dedup),
    ("decontaminate", _decontaminate),
    ("pieces", _pieces),
]

#: Learned grades, sketches and dropout aren't SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Work(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = work.save(stage(spark, docs, sf_dir), name)
    return docs
