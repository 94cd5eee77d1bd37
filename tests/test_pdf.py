import pytest
from pyspark.sql import functions as F

from folioscope.functions import pdf
from folioscope.operators import searchable


def one(text, **k):
    return pdf.page(100, 200, [pdf.Placed(text, 1, 2, 9.0)], **k)


def test_pages_keep_text_and_order():
    parts = [one(t) for t in ("first", "вторая", "\U0001f600 third\\ )", "")]
    merged = pdf.merge(parts)
    assert pdf.texts(merged) == ["first", "вторая", "\U0001f600 third\\ )", ""]
    again = pdf.split(merged)
    assert [pdf.texts(p) for p in again] == [["first"], ["вторая"], ["\U0001f600 third\\ )"], [""]]
    assert pdf.texts(pdf.merge([pdf.merge(again[:2]), pdf.merge(again[2:])])) == pdf.texts(merged)


def test_streams_may_hold_anything():
    image = b"\xff\xd8 endobj 9 0 obj << /Kids [1 0 R] >> endstream stream"
    data = pdf.merge([one("a", jpeg=image, pixels=(3, 4)), one("b", jpeg=image)])
    assert pdf.texts(data) == ["a", "b"] and data.count(image) == 2


def test_cross_references_point_at_objects():
    data = pdf.merge([one("a"), one("b")])
    start = int(data.rsplit(b"startxref", 1)[1].split()[0])
    assert data[start:].startswith(b"xref")
    for n, row in enumerate(data[start:].split(b"trailer")[0].split(b"\n")[2:-1]):
        if row.endswith(b"n "):
            assert data[int(row[:10]) :].startswith(b"%d 0 obj" % n)


def test_nothing_and_nonsense():
    empty = pdf.merge([])
    assert b"/MediaBox [0 0 1.0000 1.0000]" in empty and len(pdf.split(empty)) == 1
    for bad in (b"", b"%PDF-1.5 nothing", b"1 0 obj << /Length 5"):
        with pytest.raises(ValueError):
            pdf.read(bad)


@pytest.mark.parametrize("n", [1, 4, 5, 17, 18, 21])
def test_documents_keep_every_page(spark, n):
    rows = [(1, i, [(f"page {i}", 0.0, 0.0, 30.0, 10.0)], (100.0, 100.0), None, 200.0, 300.0) for i in range(n)]
    rows.append((2, 0, [], (0.0, 0.0), b"\xff\xd8", 10.0, 10.0))
    schema = """doc int, ix int, blocks array<struct<text:string,x_min:double,y_min:double,x_max:double,y_max:double>>,
        dims struct<ocr_width:double,ocr_height:double>, jpeg binary, width double, height double"""
    files = searchable.document_pdfs(searchable.page_pdfs(spark.createDataFrame(rows, schema)), "doc", "ix")
    got = {r.doc: list(r.t) for r in files.select("doc", searchable.text_layers(F.col("pdf")).alias("t")).collect()}
    assert got == {1: [f"page {i}" for i in range(n)], 2: [""]}


def foreign(length=b"7 0 R", more=b"", tail=b"trailer << /Size 9 /Root 1 0 R >>"):
    """A file as other programs write them: sizes and resources inherited, a length by reference, references in strings."""
    return (
        b"%PDF-1.4\n1 0 obj <</Type/Catalog/Pages 2 0 R>> endobj\n"
        b"2 0 obj <</Type/Pages/Kids 8 0 R/Count 2/MediaBox[10 20 110 220]/Resources 5 0 R>> endobj\n"
        b"3 0 obj <</Type/Page/Parent 2 0 R/Contents 6 0 R/Annots[9 0 R]>> endobj\n"
        b"4 0 obj <</Type/Page/Parent 2 0 R/CropBox[60 70 20 30]/Contents[6 0 R]>> endobj\n"
        b"5 0 obj <</Font<</F1 <</Type/Font/Subtype/Type1/BaseFont/Helvetica>> >> >> endobj\n"
        b"6 0 obj <</Length " + length + b">> stream\nBT /F1 9 Tf (3 0 R \\) endobj) Tj ET\nendstream endobj\n"
        b"7 0 obj 34 endobj 8 0 obj [3 0 R 4 0 R] endobj\n"
        b"9 0 obj <</Type/Annot/P 4 0 R/Contents(see 3 0 R \\( (and 4 0 R))>> endobj\n" + more + tail
    )


@pytest.mark.parametrize("length", [b"7 0 R", b"34", b"3", b"99 0 R"])
def test_pages_keep_what_they_inherit(length):
    first, second = pdf.split(foreign(length))
    assert pdf.box(first) == (10, 20, 100, 200) and pdf.box(second) == (20, 30, 40, 40)
    for f in (first, second):
        assert b"/Helvetica" in f and b"BT /F1 9 Tf (3 0 R \\) endobj) Tj ET" in f
        assert len(pdf.pages(*pdf.read(f))) == 1
    assert b"(see 3 0 R \\( (and 4 0 R))" in first and b"/P null" in first


def test_compressed_objects_read_the_same():
    plain = pdf.merge([foreign(), one("ours")])
    packed = pdf.merge([foreign(), one("ours")], compact=True)
    assert b"/ObjStm" in packed and b"/Helvetica" not in packed and len(packed) < len(plain)
    again = pdf.merge(pdf.split(packed))
    assert pdf.texts(again) == pdf.texts(packed) == ["", "", "ours"] and b"/Helvetica" in again
    start = int(packed.rsplit(b"startxref", 1)[1].split()[0])
    rows = pdf._unpacked({}, pdf.Obj(*_stream_at(packed, start)))
    for n in range(len(rows) // 7):
        if rows[7 * n] == 1:
            assert packed[int.from_bytes(rows[7 * n + 1 : 7 * n + 5]) :].startswith(b"%d 0 obj" % n)


def _stream_at(data, at):
    a, b = pdf._value(data, data.index(b"obj", at) + 3)
    begin = data.index(b"stream", b) + 7
    return data[a:b], data[begin : pdf._stream_end(data, begin, pdf.entries(data[a:b])[b"/Length"])[0]]


def test_later_versions_of_objects_win_and_encrypted_files_are_refused():
    newer = b"4 0 obj <</Type/Page/Parent 2 0 R/MediaBox[0 0 5 6]>> endobj\n"
    assert pdf.box(pdf.split(foreign(more=newer))[1]) == (0, 0, 5, 6)
    with pytest.raises(ValueError, match="encrypted"):
        pdf.read(foreign(tail=b"trailer << /Root 1 0 R /Encrypt 5 0 R >>"))
    with pytest.raises(ValueError, match="filter"):
        pdf.read(foreign(more=b"11 0 obj <</Type/ObjStm/N 1/First 4/Filter/LZWDecode/Length 3>> stream\nabc\nendstream endobj\n"))


def test_overlays_keep_the_page():
    page = pdf.split(foreign())[1]
    laid = pdf.overlay(page, [pdf.Placed("слой", 1, 2, 9.0), pdf.Placed("two", 3, 4, 9.0)])
    assert pdf.texts(laid) == ["слой\ntwo"] and pdf.box(laid) == (20, 30, 40, 40)
    assert pdf.texts(pdf.overlay(laid, [pdf.Placed("more", 0, 0, 5.0)])) == ["слой\ntwo\nmore"]
    shown = pdf.merge([laid])
    objects, root = pdf.read(shown)
    content = b"".join(pdf._unpacked(objects, o) for o in objects.values() if o.stream is not None)
    assert b"BT /F1 9 Tf (3 0 R \\) endobj) Tj ET" in content and b"21.0000 32.0000 Tm" in content and b"/Helvetica" in shown
    assert pdf.texts(pdf.overlay(page, [])) == [""]
    with pytest.raises(ValueError, match="no page"):
        pdf.overlay(b"1 0 obj << /Type /Catalog >> endobj trailer << /Root 1 0 R >>", [])


def test_stand_in_renderer():
    scan = pdf.scan_or_white(one("a", jpeg=b"\xff\xd8 scan", pixels=(3, 4)), 100, 80)
    assert scan == pdf.Raster(b"\xff\xd8 scan", 3, 4)
    white = pdf.scan_or_white(one("a"), 144, 80)
    assert (white.width, white.height, white.jpeg) == (200, 400, False)
    again = pdf.page(100, 200, raster=white)
    assert pdf.texts(again) == [""] and b"/DeviceGray" in again


def test_pages_are_rendered_and_overlaid(spark):
    blocks = "array<struct<text:string,x_min:double,y_min:double,x_max:double,y_max:double>>"
    rows = [(0, foreign(), [("word", 0.0, 0.0, 50.0, 100.0)], (100.0, 200.0)), (1, one("old"), [("w", 0.0, 0.0, 1.0, 1.0)], (0.0, 0.0)), (2, one("old"), [], None), (3, one("old"), None, None)]
    df = spark.createDataFrame(rows, f"i int, pdf binary, blocks {blocks}, dims struct<ocr_width:double,ocr_height:double>")
    laid = searchable.overlay_pages(df)
    assert laid.columns == df.columns
    got = {r.i: (pdf.texts(bytes(r.pdf)), r.size) for r in searchable.render_pages(laid, lambda f, dpi, q: pdf.Raster(b"\xff\xd8", dpi, q)).select("i", "pdf", F.col("n_bytes").alias("size")).collect()}
    assert got == {0: (["word"], 2), 1: (["old"], 2), 2: (["old"], 2), 3: (["old"], 2)}
