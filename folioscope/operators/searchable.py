"""Searchable PDFs: page images, a text layer on every page, and documents merged from their pages."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions import pdf
from folioscope.operators.merge import merge_tree
from folioscope.operators.recognition import overlay_geometry
from folioscope.shipping import ship


def _placed(spots, words) -> list[pdf.Placed]:
    """Texts with their places; those without a place aren't drawn."""
    out = []
    for spot, word in zip(() if spots is None else spots, () if words is None else words, strict=True):
        if spot is not None:
            natural = pdf.text_width(word, spot["font_size"])
            scale = 100.0 * spot["width"] / natural if natural > 0 and spot["width"] > 0 else 100.0
            out.append(pdf.Placed(word, spot["x"], spot["y"], spot["font_size"], scale))
    return out


def _places(width: Column | str, height: Column | str) -> list[Column]:
    """Places and texts of the column blocks on pages of the given size."""
    size = [F.col(c) if isinstance(c, str) else c for c in (width, height)]
    return [F.transform("blocks", lambda b: overlay_geometry(b, F.col("dims"), *size)), F.transform("blocks", lambda b: b["text"])]


def _drawn(jpeg: pd.Series, places: pd.Series, lines: pd.Series, width: pd.Series, height: pd.Series, pixels: pd.Series) -> pd.Series:
    out = []
    for image, spots, words, w, h, px in zip(jpeg, places, lines, width, height, pixels.to_dict("records") if isinstance(pixels, pd.DataFrame) else pixels, strict=True):
        out.append(pdf.page(w, h, _placed(spots, words), bytes(image) if image is not None else None, (int(px["w"]), int(px["h"]))))
    return pd.Series(out)


def page_pdfs(pages: DataFrame) -> DataFrame:
    """pages(blocks, dims, jpeg, width, height, ...) with pdf: one page each. Without blocks or page size, no text layer."""
    ship(pages.sparkSession)
    pixels = F.struct(F.greatest(F.col("dims.ocr_width"), F.lit(1.0)).cast("int").alias("w"), F.greatest(F.col("dims.ocr_height"), F.lit(1.0)).cast("int").alias("h"))
    places, words = _places("width", "height")
    return pages.withColumn("pdf", F.pandas_udf(_drawn, "binary")("jpeg", places, words, "width", "height", pixels))


def _boxes(files: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([pdf.box(bytes(f)) for f in files], columns=["left", "bottom", "width", "height"])


def _overlaid(files: pd.Series, places: pd.Series, lines: pd.Series) -> pd.Series:
    return pd.Series([pdf.overlay(bytes(f), _placed(s, w)) for f, s, w in zip(files, places, lines, strict=True)])


def overlay_pages(pages: DataFrame) -> DataFrame:
    """pages(pdf, blocks, dims, ...) with the texts of blocks laid over the given one-page files, scaled to their crop boxes.

    Without blocks, or where dims isn't positive, a page stays as it is.
    """
    ship(pages.sparkSession)
    measured = pages.withColumn("_box", F.pandas_udf(_boxes, "left double, bottom double, width double, height double")("pdf"))
    drawn = F.pandas_udf(_overlaid, "binary")("pdf", *_places(F.col("_box.width"), F.col("_box.height")))
    return measured.withColumn("pdf", drawn).drop("_box")


#: Bytes of a one-page file, dots per inch and JPEG quality to a picture of the page.
Renderer = Callable[[bytes, int, int], pdf.Raster]


def render_pages(pages: DataFrame, renderer: Renderer = pdf.scan_or_white, dpi: int = 100, quality: int = 80) -> DataFrame:
    """pages(pdf, ...) with image_pdf, a page of the same size that shows only the picture, and n_bytes of that picture.

    n_bytes is what sub-batches are packed by. The default renderer is a stand-in.
    """
    ship(pages.sparkSession)

    def run(files: pd.Series) -> pd.DataFrame:
        out = []
        for f in files:
            raster, (_, _, width, height) = renderer(bytes(f), dpi, quality), pdf.box(bytes(f))
            out.append((pdf.page(width, height, raster=raster), len(raster.data)))
        return pd.DataFrame(out, columns=["file", "size"])

    made = pages.withColumn("_made", F.pandas_udf(run, "file binary, size bigint")("pdf"))
    return made.withColumns({"image_pdf": F.col("_made.file"), "n_bytes": F.col("_made.size")}).drop("_made")


def _merged(parts: pd.Series) -> pd.Series:
    return pd.Series([pdf.merge([bytes(p) for p in ps]) for ps in parts])


def merge_pdfs(parts: Column) -> Column:
    """A merger for merge_tree: files of an array to one file."""
    ship()
    return F.pandas_udf(_merged, "binary")(parts)


def _compact(files: pd.Series) -> pd.Series:
    return pd.Series([pdf.merge([bytes(f)], compact=True) for f in files])


def compacted(files: Column) -> Column:
    """Files rewritten with compressed object streams."""
    ship()
    return F.pandas_udf(_compact, "binary")(files)


def document_pdfs(pages: DataFrame, key: str, order: str, content: str = "pdf", fan_in: int = 4) -> DataFrame:
    """(key, content): one file per document; `order` counts its pages from 0 without gaps."""
    return merge_tree(pages, key, order, content, fan_in, merge_pdfs)


def _texts(files: pd.Series) -> pd.Series:
    return pd.Series([pdf.texts(bytes(f)) for f in files])


def text_layers(files: Column) -> Column:
    """Text layer of each page of a file."""
    ship()
    return F.pandas_udf(_texts, "array<string>")(files)
