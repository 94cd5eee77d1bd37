"""Page rows: chunk and batch numbers, byte-bounded packing, positional joins, assembly.

Everything is one row per page, (document, page_no from 0, ...). Chunks, batches
and sub-batches are columns, not files, and a result document is one ordered
aggregate over the page rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.text import pytrim


def positive(name: str, n: int) -> int:
    if n <= 0:
        raise ValueError(f"{name} must be > 0")
    return n


def with_chunks(pages: DataFrame, chunk_size: int = 50, batch_size: int = 10) -> DataFrame:
    """chunk_id, and batch_id counted anew in each chunk, from page_no."""
    positive("chunk_size", chunk_size)
    positive("batch_size", batch_size)
    return pages.withColumns(
        {
            "chunk_id": F.expr(f"cast(page_no div {chunk_size} as int)"),
            "batch_id": F.expr(f"cast((page_no % {chunk_size}) div {batch_size} as int)"),
        }
    )


def pack(sizes: Column, limit: int) -> Column:
    """Bin of each size, in order: a bin closes when it isn't empty and the next size would exceed the limit.

    A running sum with a reset, which no window sum expresses: a fold over the
    group's sizes. A size over the limit has a bin to itself.
    """
    zero = F.struct(
        F.lit(0).cast("bigint").alias("sum"), F.lit(0).alias("held"), F.lit(0).alias("bin"), F.array().cast("array<int>").alias("bins")
    )

    def step(acc: Column, size: Column) -> Column:
        full = (acc["held"] > 0) & (acc["sum"] + size > limit)
        number = acc["bin"] + full.cast("int")
        return F.struct(
            F.when(full, size).otherwise(acc["sum"] + size).alias("sum"),
            F.when(full, 1).otherwise(acc["held"] + 1).alias("held"),
            number.alias("bin"),
            F.concat(acc["bins"], F.array(number)).alias("bins"),
        )

    return F.aggregate(sizes, zero, step, lambda acc: acc["bins"])


def with_sub_batches(pages: DataFrame, group: list[str], order: str, size: str, limit: int = 9_000_000) -> DataFrame:
    """sub_id per page: greedy packing within each group. Groups are batches, so a fold never sees more than one."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(size).cast("bigint").alias("s"), F.struct("*").alias("row"))))
    packed = pages.groupBy(*group).agg(rows.alias("_rows"))
    bins = pack(F.transform("_rows", lambda x: x["s"]), limit)
    out = packed.select(F.explode(F.arrays_zip(F.transform("_rows", lambda x: x["row"]).alias("row"), bins.alias("sub_id"))).alias("x"))
    return out.select("x.row.*", "x.sub_id")


def positional_left_join(pages: DataFrame, results: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """The i-th page of each group with the i-th result; pages without one are failed and empty, surplus results go.

    Both sides hold an integer `pos` from 0 within their group.
    """
    right = results.select(*keys, "pos", F.col(text).alias("_text"), F.lit(True).alias("ok"))
    joined = pages.join(right, [*keys, "pos"], "left")
    return joined.withColumns({"ok": F.coalesce("ok", F.lit(False)), "text": F.coalesce("_text", F.lit(""))}).drop("_text")


def fill_missing(pages: DataFrame, results: DataFrame, keys: list[str]) -> DataFrame:
    """Every page of the list, with the text of its result or an empty one."""
    return pages.join(results.select(*keys, F.col("text").alias("_t")), keys, "left").withColumn("text", F.coalesce("_t", F.lit(""))).drop("_t")


def ordered_text(pages: DataFrame, keys: list[str], order: str, text: str, separator: str, name: str = "text") -> DataFrame:
    """Texts of each group joined in order. Null texts count as empty, so no page vanishes."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce(F.col(text), F.lit("")).alias("t"))))
    return pages.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda x: x["t"]), separator).alias(name))


def document_texts(pages: DataFrame, keys: list[str], separator: str = "\n\n") -> DataFrame:
    """Flat text of each document: joining pages into chunks and chunks into documents is one join of pages."""
    return ordered_text(pages, keys, "page_no", "text", separator)


def document_json(pages: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, result): {"data": [{"page", "text"}]} as a struct, pages counted from 1."""
    items = F.array_sort(F.collect_list(F.struct((F.col("page_no") + 1).cast("int").alias("page"), F.coalesce("text", F.lit("")).alias("text"))))
    return pages.groupBy(*keys).agg(F.struct(items.alias("data")).alias("result"))


def page_lines(pages: DataFrame) -> DataFrame:
    """One JSON line per page: {"page": n + 1, "text": ...}."""
    return pages.withColumn("line", F.to_json(F.struct((F.col("page_no") + 1).alias("page"), F.coalesce("text", F.lit("")).alias("text"))))


def pages_grouped(items: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, page, text) of items(keys, page, pos, text): trimmed non-blank texts joined by line feeds in order of pos."""
    kept = items.withColumn("text", pytrim(F.col("text"))).where(F.col("page").isNotNull() & (F.col("text") != ""))
    joined = ordered_text(kept, [*keys, "page"], "pos", "text", "\n")
    return joined.withColumn("text", pytrim(F.col("text")))


def loss_summary(pages: DataFrame, keys: list[str], max_failed: int = 0, report: int = 30) -> DataFrame:
    """Pages in all, ok and failed, the first failed page numbers (from 1), and whether the document is done or failed."""
    failed = F.array_sort(F.collect_list(F.when(~F.col("ok"), (F.col("page_no") + 1).cast("int"))))
    out = pages.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_pages"), F.count_if(F.col("ok")).alias("n_ok"), F.count_if(~F.col("ok")).alias("n_failed"), F.slice(failed, 1, report).alias("failed_pages")
    )
    return out.withColumn("status", F.when(F.col("n_failed") > max_failed, "failed").otherwise("ocr_done"))


def output_key(document: Column, chunk: Column | None = None, page: Column | None = None, sub: Column | None = None) -> Column:
    """Path of an intermediate: document/chunk_00001/page_000002/sub_003."""
    parts = [document]
    for column, form in ((chunk, "chunk_%05d"), (page, "page_%06d"), (sub, "sub_%03d")):
        if column is not None:
            parts.append(F.format_string(form, column))
    return F.concat_ws("/", *parts)
