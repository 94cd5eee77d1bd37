"""Line dedup by range-partitioned hashes and per-document bitmaps (operator 1, native).

A text is split at \\n; a line's key is the line stripped of ASCII white space
with A-Z lower-cased. Keys of at least `min_chars` code points that occur in at
least `min_docs` documents lose all their lines but those of the largest
doc_id that holds the key.

How it runs: every long line becomes (128-bit key hash, document, text, position),
with no line. Those rows are range-partitioned by (hash, document) and sorted
by text and position within, so one very common line spreads over as many partitions as
it fills. One pass over each sorted range numbers the occurrences of a key in a
document as they stream by; first ones count documents, and a partition passes on
one row per key: how many documents, and the last. Rows of shared keys alone, told by a bitmap of fixed
size, meet the verdicts in a salted join. What comes
out is a compressed keep bitmap per text that loses lines: 64-bit words in which
kept lines are ones; words that are all ones are left out. Texts that lose nothing are never
shuffled.

Defined cases: a null or empty text is one empty line and is never dropped;
rows that share a doc_id count as one document; a null doc_id counts as one
document smaller than all others; repeated rows are treated alike and all
returned; an empty table gives an empty result. Columns other than doc_id and
text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.llm.common import Work, ascii_lower, keep_members, mark_members, skew_join, strip_ws

_NO_ID = -(2**63)


def _lines(text) -> F.Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _with_row(docs: DataFrame) -> DataFrame:
    """_ld_doc: the document; _ld_row: which text of it, as positions belong to a text."""
    return docs.withColumns(
        {
            "_ld_doc": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID)),
            "_ld_row": F.xxhash64(F.coalesce("text", F.lit(""))),
        }
    )


def line_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, within_document: bool = False) -> DataFrame:
    """(_ld_doc, _ld_row, _ld_dropped, _ld_keep): the keep bitmap of each text that loses lines.

    within_document: the document that keeps a key also loses all but its first line with it.
    """
    work = Work(docs.sparkSession, "lines")
    lines = work.save(
        _with_row(docs.select("doc_id", "text"))
        .select("_ld_doc", "_ld_row", F.posexplode(_lines(ascii_lower(F.col("text")))).alias("pos", "line"))
        .withColumn("line", strip_ws(F.col("line")))
        .where(F.char_length("line") >= min_chars)
        .select(
            F.xxhash64("line").alias("h1"),
            F.xxhash64(F.lit(7), "line").alias("h2"),
            F.col("_ld_doc").alias("doc"),
            F.col("_ld_row").alias("row"),
            "pos",
        ),
        "lines",
    )
    # A window over what is range-partitioned by its own keys needs no further shuffle, and its order is the sort's.
    streamed = Window.partitionBy("h1", "h2", "doc").orderBy("row", "pos")
    ranged = work.save(
        lines.repartitionByRange("h1", "h2", "doc").sortWithinPartitions("h1", "h2", "doc", "row", "pos").withColumns({"first": F.row_number().over(streamed) == 1, "nth": F.dense_rank().over(streamed)}),  # equal rows are one occurrence
        "ranged",
    )
    work.drop("lines")
    verdicts = work.save(
        ranged.groupBy("h1", "h2")
        .agg(F.count_if("first").alias("n"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("w"))
        .where(F.col("n") >= min_docs)
        .select("h1", "h2", "last", "w"),
        "verdicts",
    )
    gone = F.col("doc") != F.col("last")
    if within_document:
        gone = gone | (F.col("nth") > 1)
    return work.save(
        skew_join(keep_members(ranged, "h1", verdicts), verdicts, ["h1", "h2"], "w", "doc")
        .where(gone)
        .groupBy(F.col("doc").alias("_ld_doc"), F.col("row").alias("_ld_row"), F.expr("pos div 64").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(pos % 64 as int)))").alias("lost"))
        .groupBy("_ld_doc", "_ld_row")
        .agg(
            F.sum(F.bit_count("lost")).cast("bigint").alias("_ld_dropped"),
            F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("lost").alias("bits")))).alias("_ld_keep"),
        ),
        "bitmaps",
    )


def _dropped_positions(words) -> F.Column:
    return F.flatten(
        F.transform(
            words,
            lambda w: F.filter(
                F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: (w["word"] * 64 + i).cast("int")),
                lambda p: F.getbit(w["bits"], F.pmod(p, F.lit(64))) == 0,
            ),
        )
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """docs with text rebuilt from the kept lines, and _ld_lines, _ld_dropped (counts), _ld_empty (no line left)."""
    marked = mark_members(_with_row(docs), "_ld_doc", bitmaps, "_ld_may")
    lines = _lines(F.col("text"))
    whole = [F.size(lines).cast("bigint").alias("_ld_lines"), F.lit(0).cast("bigint").alias("_ld_dropped"), F.lit(False).alias("_ld_empty")]
    kept = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.coalesce(_dropped_positions(F.col("_ld_keep")), F.array().cast("array<int>"))),
        lambda i: F.get(lines, i),
    )
    # A text has one bitmap, about a hundredth of its size: bitmaps are hashed, and texts aren't sorted to meet them.
    met = marked.where("_ld_may").join(bitmaps.hint("shuffle_hash"), ["_ld_doc", "_ld_row"], "left")
    counts = [whole[0], F.coalesce("_ld_dropped", F.lit(0).cast("bigint")).alias("_ld_dropped"), F.coalesce(F.col("_ld_dropped") == F.size(lines), F.lit(False)).alias("_ld_empty")]
    text = F.when(F.col("_ld_keep").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text")
    rebuilt = met.select(*[text if c == "text" else F.col(c) for c in docs.columns], *counts)
    return rebuilt.unionByName(marked.where("not _ld_may").select(*docs.columns, *whole))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, within_document: bool = False) -> DataFrame:
    """Bitmaps made and applied: docs with only kept lines, plus the _ld_ counts."""
    return apply_bitmaps(docs, line_bitmaps(docs, min_chars, min_docs, within_document))


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id",
        F.col("_ld_lines").alias("n_lines"),
        F.col("_ld_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


OP1_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT doc_id, pos, line,
    translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), shared AS (
  SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT d.doc_id, d.pos, d.line, s.k IS NOT NULL AND d.doc_id <> s.last AS gone
  FROM keyed d LEFT JOIN shared s ON d.k = s.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
