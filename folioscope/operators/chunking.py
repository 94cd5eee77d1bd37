"""Marked text, overlapping windows and the pages they belong to.

A document's text carries [PAGE n] markers. Windows are closed-form: window i
starts at i * (window - overlap), and there are 1 + ceil((L - window) / step) of
them. One pass cuts the text in pieces of one step each, and a window is the head
of a few neighbouring pieces, so no window looks at the whole text. Pages are
attributed in the row by bisecting the markers' positions: those that start in
the window, else the last before it. Only the finished windows are exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.arrays import find_all, let, sorted_before
from folioscope.functions.text import MARKER, MAX_BODY, chunk_body, pytrim, strip_markers
from folioscope.operators.pages import ordered_text


def check_window(window: int, overlap: int, limit: int = MAX_BODY) -> tuple[int, int]:
    """The window, clamped to the limit, and its step. Validated after clamping, so the step is always positive."""
    if window <= 0:
        raise ValueError("window must be > 0")
    window = min(window, limit)
    if not 0 <= overlap < window:
        raise ValueError("overlap must be >= 0 and < window")
    return window, window - overlap


def marked_text(pages: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, marked) of pages(keys, page, text)."""
    parts = pages.withColumn("_part", F.concat(F.lit("[PAGE "), F.col("page").cast("string"), F.lit("]\n"), F.col("text"), F.lit("\n")))
    joined = ordered_text(parts, keys, "page", "_part", "\n", "marked")
    return joined.withColumn("marked", F.concat(pytrim(F.col("marked")), F.lit("\n")))


def markers(marked: Column) -> Column:
    """(pos, page) of every marker, found in the text itself, so literal markers count too."""
    return F.transform(
        find_all(marked, MARKER, 1), lambda m: F.struct(m["pos"].alias("pos"), m["value"].try_cast("bigint").alias("page"))
    )


def cut(text: Column, window: int, step: int) -> Column:
    """Array of (chunk_ix, start, end, slice) of a text, in code points."""
    pieces_of_window = -(-window // step)

    def of(pieces: Column) -> Column:
        size = step * (F.size(pieces) - 1) + F.char_length(F.element_at(pieces, -1))
        n = (1 + F.greatest(F.lit(0), F.ceil((size - window) / step))).cast("int")

        def one(i: Column) -> Column:
            part = F.substring(F.array_join(F.slice(pieces, i + 1, pieces_of_window), ""), 1, window)
            return F.struct(i.alias("chunk_ix"), (i * step).alias("start"), (i * step + F.char_length(part)).alias("end"), part.alias("slice"))

        return F.when(F.size(pieces) > 0, F.transform(F.sequence(F.lit(0), n - 1), one)).otherwise(F.array().cast(_WINDOWS))

    return let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0)), of)


_WINDOWS = "array<struct<chunk_ix:int,start:int,end:int,slice:string>>"


def windows(docs: DataFrame, window: int = 400, overlap: int = 50, text: str = "marked") -> DataFrame:
    """A row per window: chunk_ix, start, end and slice, in code points."""
    return docs.withColumn("_w", F.explode(cut(F.col(text), *check_window(window, overlap)))).select(*docs.columns, "_w.*")


def pages_of(found: Column, start: Column, end: Column) -> Column:
    """Distinct pages whose marker starts in [start, end), in order; else the last page before it; else none.

    found: the markers as one struct of two arrays, pos and page, by position.
    """

    def of(x: Column) -> Column:
        inside = F.array_distinct(F.slice(found["page"], x["lo"] + 1, x["hi"] - x["lo"]))
        before = F.when(x["lo"] > 0, F.array(F.get(found["page"], x["lo"] - 1))).otherwise(F.array().cast("array<bigint>"))
        return F.when(x["hi"] > x["lo"], inside).otherwise(before)

    return let(F.struct(sorted_before(found["pos"], start).alias("lo"), sorted_before(found["pos"], end).alias("hi")), of)


def chunk_bodies(docs: DataFrame, keys: list[str], window: int = 400, overlap: int = 50) -> DataFrame:
    """(keys, chunk_ix, pages, body) of docs(keys, marked); windows of markers and blanks only are dropped."""
    window, step = check_window(window, overlap)

    def paged(found: Column) -> Column:
        def of(w: Column) -> Column:
            return F.struct(w["chunk_ix"].alias("chunk_ix"), w["slice"].alias("slice"), pages_of(found, w["start"], w["end"]).alias("pages"))

        return F.transform(cut(F.col("marked"), window, step), of)

    two = lambda ms: F.struct(F.transform(ms, lambda m: m["pos"]).alias("pos"), F.transform(ms, lambda m: m["page"]).alias("page"))
    found = let(markers(F.col("marked")), two)
    out = docs.select(*keys, F.explode(let(found, paged)).alias("_w")).select(*keys, "_w.chunk_ix", "_w.pages", strip_markers(F.col("_w.slice")).alias("fragment"))
    return out.where("fragment <> ''").select(*keys, "chunk_ix", "pages", chunk_body(F.col("pages"), F.col("fragment")).alias("body"))


def chunk_counts(bodies: DataFrame, keys: list[str]) -> DataFrame:
    return bodies.groupBy(*keys).agg(F.count(F.lit(1)).alias("chunks_count"))
