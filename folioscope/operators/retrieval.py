"""Retrieval: vector top-k, lexical top-k, contexts, answers, and index lookup."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions.arrays import let
from folioscope.functions.text import fixed
from folioscope.shipping import ship

#: Answer when nothing was found, and the line that introduces a source. Fixed values.
NO_HITS = "В базе нет релевантной информации по этому вопросу."
SOURCE = "Источник %d (score=%s, файл=%s):\n%s"


def rank_hits(hits: DataFrame, query: str, score: str, ids: list[str], k: int = 10, threshold: float = 0.0) -> DataFrame:
    """The k best hits of each query with rank from 1: by score, then by ids. Null and low scores are dropped first."""
    order = Window.partitionBy(query).orderBy(F.col(score).desc(), *ids)
    kept = hits.where(F.col(score).isNotNull() & (F.col(score) >= threshold))
    return kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def topk_cosine(
    queries: DataFrame, vectors: DataFrame, k: int = 10, threshold: float = 0.0, block: int = 2048, digits: int = 6
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k vectors nearest to each query by cosine, rounded to `digits`.

    queries(query_id, embedding), vectors(vec_id, embedding). Queries are dealt in
    blocks of about `block` of one dimension; each block's matrix is broadcast and multiplied with
    the vectors batch by batch, and a batch keeps only its k best per query, so what is
    shuffled grows with partitions, not with pairs. Queries and vectors that are null, or have no length
    or a null in them, have no hits; those of different dimensions don't meet. The vectors are read once
    per block, so the plan grows with the number of queries: it is meant for thousands of them.
    """
    ship()
    usable = lambda df: df.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~F.exists("embedding", lambda x: x.isNull()))
    asked = usable(queries).select("query_id", F.col("embedding").cast("array<double>").alias("embedding"), F.size("embedding").alias("width"))
    n = {r["width"]: r["n"] for r in asked.groupBy("width").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per dimension
    found = None
    for width, count in sorted(n.items()):
        blocks = -(-count // block)
        own = asked.where(F.col("width") == width).withColumn("_b", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
        part = usable(vectors).where(F.size("embedding") == width).select("vec_id", "embedding")
        for b in range(blocks):
            rows = own.where(F.col("_b") == b).select("query_id", "embedding").orderBy("query_id").collect()  # about `block` rows
            ids = np.array([r["query_id"] for r in rows], np.int64)
            matrix = np.array([r["embedding"] for r in rows], np.float64).reshape(len(ids), width)
            shared = queries.sparkSession.sparkContext.broadcast((ids, _unit(matrix)))
            hits = part.mapInPandas(_best(shared, k, threshold, digits), "query_id long, vec_id long, score double")
            found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = queries.sparkSession.createDataFrame([], "query_id long, vec_id long, score double")
    return rank_hits(found, "query_id", "score", ["vec_id"], k, threshold)


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; NaN where there is none."""
    lengths = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, lengths, out=np.full_like(rows, np.nan), where=lengths > 0)


def _best(shared, k: int, threshold: float, digits: int, cells: int = 1 << 22) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Per batch of vectors the k best of each query: by partial selection, with all that tie with the k-th kept until sorted."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, q = shared.value
        for batch in batches:
            step = max(1, cells // max(1, len(ids)))
            for a in range(0, len(batch), step):  # bounds the matrix of scores
                vec = batch["vec_id"].to_numpy()[a : a + step]
                m = _unit(np.stack(batch["embedding"].to_numpy()[a : a + step]).astype(np.float64))
                s = np.round(q @ m.T, digits)
                s[np.isnan(s) | (s < threshold)] = -np.inf
                floor = np.partition(s, -k, axis=1)[:, -k] if s.shape[1] > k else np.full(len(ids), -np.inf)
                row, col = np.nonzero((s >= floor[:, None]) & (s > -np.inf))
                order = np.lexsort((vec[col], -s[row, col], row))
                row, col = row[order], col[order]
                first = np.searchsorted(row, row)
                kept = np.arange(len(row)) - first < k
                yield pd.DataFrame({"query_id": ids[row[kept]], "vec_id": vec[col[kept]], "score": s[row[kept], col[kept]]})

    return run


def shingle_keys(text: Column, n: int = 3) -> Column:
    """Distinct n-word shingles of a lower-cased text, as hashes."""
    def of(words: Column) -> Column:
        keys = F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.xxhash64(F.array_join(F.slice(words, i, n), " ")))
        return F.when(F.size(words) < n, F.array().cast("array<bigint>")).otherwise(F.array_distinct(keys))

    return let(F.array_remove(F.split(F.lower(text), "\\s+"), ""), of)


def lexical_retrieval(questions: DataFrame, docs: DataFrame, k: int = 3, n: int = 3, threshold: float = 1.0, salts: int = 4) -> DataFrame:
    """(query_id, rank, doc_id, score): documents that share most n-word shingles with a question.

    questions(query_id, text), docs(doc_id, text). An equi-join on shingles, which
    are rare, so work follows the number of matches. Should the questions be too many to broadcast,
    a common phrase is spread: documents' shingles get one of `salts` salts, the questions' all of them.
    """
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int")
    q = questions.select("query_id", F.explode(shingle_keys(F.col("text"), n)).alias("key")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    d = docs.select("doc_id", F.explode(shingle_keys(F.col("text"), n)).alias("key")).withColumn("salt", salt)
    hits = d.join(q, ["key", "salt"]).groupBy("query_id", "doc_id").agg(F.count(F.lit(1)).cast("double").alias("score"))
    return rank_hits(hits, "query_id", "score", ["doc_id"], k, threshold).select("query_id", "rank", "doc_id", "score")


def contexts(ranked: DataFrame, query: str) -> DataFrame:
    """(query, context, n_hits): numbered sources joined by blank lines, scores as %.4f. ranked(query, rank, score, filename, text)."""
    line = F.format_string(SOURCE, "rank", fixed(F.col("score"), 4), "filename", F.coalesce("text", F.lit("")))
    parts = F.array_sort(F.collect_list(F.struct("rank", line.alias("line"))))
    return ranked.groupBy(query).agg(F.array_join(F.transform(parts, lambda x: x["line"]), "\n\n").alias("context"), F.count(F.lit(1)).alias("n_hits"))


def hit_text(content: Column) -> Column:
    """Text of a hit's first content element, or empty."""
    return F.coalesce(F.get(content, 0)["text"], F.lit(""))


def answers(questions: DataFrame, context: DataFrame, generator: Callable[[Column, Column], Column], query: str = "query_id") -> DataFrame:
    """questions with context (null without hits), model_answer and status, for all questions in one plan.

    generator(question, context) is a column: usually a pandas UDF round a model.
    """
    joined = questions.join(context, query, "left")
    return joined.withColumns(
        {
            "model_answer": F.when(F.col("context").isNull(), NO_HITS).otherwise(generator(F.col("question"), F.col("context"))),
            "status": F.lit("ok"),
        }
    ).drop("n_hits")


def answer_rows(runs: DataFrame) -> DataFrame:
    """runs(ok, stdout, stderr, ...) with model_answer, status, error and stderr as an answered question has them."""
    ok = F.col("ok")
    err = F.coalesce(F.nullif("stderr", F.lit("")), F.nullif("stdout", F.lit("")), F.lit("unknown error"))
    return runs.withColumns(
        {"model_answer": F.when(ok, F.col("stdout")), "status": F.when(ok, "ok").otherwise("error"), "error": F.when(~ok, err)}
    )


def last_wins(registry: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """(key, value) of the last record of each key."""
    return registry.groupBy(key).agg(F.max_by(value, order).alias(value))


def name_map(registry: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One row with the last-wins mapping as a map in key order. For registries, whose size is that of a catalogue."""
    entries = F.array_sort(F.collect_list(F.struct(key, value)))
    return last_wins(registry, key, value, order).agg(F.map_from_entries(entries).alias("names"))


def resolve_index(registry: DataFrame, index_id: str | None = None, name: str | None = None, dataset: str | None = None, order: str = "ord") -> str:
    """The id by precedence: given id, then name, then dataset; the last record of equals. ValueError if there is none."""
    if index_id:
        return index_id
    for column, wanted in (("name", name), ("dataset_dir", dataset)):
        if wanted:
            row = registry.where(F.col(column) == wanted).agg(F.max_by("vector_store_id", order).alias("id")).first()
            if row["id"] is None:
                raise ValueError(f"no index with {column} {wanted!r}")
            return row["id"]
    raise ValueError("one of index_id, name and dataset is needed")


def terminal(status: Column) -> Column:
    """Whether an index is done, well or not."""
    return status != "in_progress"


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """df, or ValueError if it is empty."""
    if df.isEmpty():
        raise ValueError(f"no {what}")
    return df


def one_selector(*selectors) -> None:
    if sum(bool(s) for s in selectors) != 1:
        raise ValueError("exactly one selector is needed")
