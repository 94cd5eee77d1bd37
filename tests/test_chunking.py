import bisect
import re
import time

import pytest
from pyspark.sql import functions as F

from folioscope.functions.arrays import bag, find_all, scan, sorted_before
from folioscope.operators import chunking

#: Texts, and the bodies of their windows of 20 with an overlap of 5, worked out by hand: (window, pages, body).
BY_HAND = {
    # one window: the marker goes, its page stays
    "[PAGE 1]\nabc\n": [(0, [1], "PAGES: 1\nabc")],
    # 0-20 holds marker 1; 15-35 starts within "bbbb" and holds marker 2; 30-40 has no marker, so page 2 goes on
    "[PAGE 1]\naaaa bbbb cc\n[PAGE 2]\ndddd eeee": [
        (0, [1], "PAGES: 1\naaaa bbbb c"),
        (1, [2], "PAGES: 2\nbbb cc\ndddd"),
        (2, [2], "PAGES: 2\ndddd eeee"),
    ],
    # nothing before it says which page it is
    "no marker at all": [(0, [], "PAGES: unknown\nno marker at all")],
    # two markers in one window, one of them twice
    "[PAGE 3]a[PAGE 3]b": [(0, [3], "PAGES: 3\na\nb")],
    "[PAGE 1]x[PAGE 22]y": [(0, [1, 22], "PAGES: 1-22\nx\ny")],
    # markers and blanks only
    "[PAGE 1]\n \n": [],
    "": [],
    # code points, not bytes or UTF-16 units: 0-20 has 11 of them after the marker, 15-30 the last 15
    "[PAGE 4]\n" + "\U0001f600" * 21: [(0, [4], "PAGES: 4\n" + "\U0001f600" * 11), (1, [4], "PAGES: 4\n" + "\U0001f600" * 15)],
}


def test_bodies_by_hand(spark):
    df = spark.createDataFrame(list(enumerate(BY_HAND)), "doc int, marked string")
    rows = chunking.chunk_bodies(df, ["doc"], 20, 5).orderBy("doc", "chunk_ix").collect()
    for doc, want in enumerate(BY_HAND.values()):
        assert [(r.chunk_ix, list(r.pages), r.body) for r in rows if r.doc == doc] == want, doc


TEXTS = [
    "\n".join(f"[PAGE {i}]\n{'word ' * 40}{i}\n" for i in (1, 2, 7, 2)),
    "[PAGE 1]\nsee [PAGE  99] there " + "x" * 60 + "\n\n[PAGE 2]\nend\n",
    "\U0001f600a\n" * 70,
    "x" * 25,
    "y",
    "",
]


@pytest.mark.parametrize(("window", "overlap"), [(40, 10), (25, 0), (9, 8), (400, 50), (1, 0)])
def test_windows_in_closed_form(spark, window, overlap):
    """What must hold of windows: their number, where each is, and that the new parts of all of them are the text."""
    step = window - overlap
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc int, marked string")
    rows = chunking.windows(df, window, overlap).collect()
    for doc, text in enumerate(TEXTS):
        got = sorted((r.chunk_ix, r.start, r.end, r.slice) for r in rows if r.doc == doc)
        assert len(got) == (len(text) > 0) + max(0, -(-(len(text) - window) // step))
        assert all((start, end, s) == (i * step, min(i * step + window, len(text)), text[start:end]) for i, start, end, s in got)
        assert "".join(s[0 if not i else overlap :] for i, _, _, s in got) == text


@pytest.mark.parametrize(("window", "overlap"), [(40, 10), (25, 0), (9, 8)])
def test_pages_are_those_of_the_markers(spark, window, overlap):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc int, marked string")
    for r in chunking.chunk_bodies(df, ["doc"], window, overlap).collect():
        marks = [(m.start(), int(m[1])) for m in re.finditer(r"\[PAGE\s+(\d+)\]", TEXTS[r.doc])]
        at = r.chunk_ix * (window - overlap)
        first, last = (bisect.bisect_left(marks, (x,)) for x in (at, at + window))
        assert list(r.pages) == (sorted(set(p for _, p in marks[first:last]), key=[p for _, p in marks[first:last]].index) or [p for _, p in marks[:first]][-1:])


def seconds(df):
    began = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def test_work_in_a_row_grows_with_its_length(spark):
    """Sixteen times the matches, tokens or windows in one row take far less than 256 times as long."""
    n = F.col("n").cast("int")

    def row(k):
        return spark.createDataFrame([(k,)], "n int").withColumn("text", F.repeat(F.lit("[PAGE 7]ab cd "), n))

    for work in (
        lambda df: df.select(find_all(F.col("text"), "\\d", 0).alias("x")),
        lambda df: df.select(bag(F.split("text", " ")).alias("x")),
        lambda df: chunking.chunk_bodies(df.select("n", F.col("text").alias("marked")), ["n"], 40, 4),
    ):
        seconds(work(row(2000)))
        small, large = (min(seconds(work(row(k))) for _ in range(2)) for k in (2000, 32_000))
        assert large < 60 * max(small, 0.05)


def test_scans_and_bisection(spark):
    values = [5, -1, 3, 3, 0, 9, 2]
    df = spark.createDataFrame([(values, sorted(values)), ([], []), ([4], [4])], "v array<int>, s array<int>")
    for r in df.select("v", "s", scan(F.col("v"), lambda a, b: a + b).alias("sums"), scan(F.col("v"), F.greatest).alias("most"), *[sorted_before(F.col("s"), F.lit(x)).alias(f"b{x}") for x in (-2, 3, 4, 99)]).collect():
        assert r.sums == [sum(r.v[: i + 1]) for i in range(len(r.v))] and r.most == [max(r.v[: i + 1]) for i in range(len(r.v))]
        assert [r[f"b{x}"] for x in (-2, 3, 4, 99)] == [bisect.bisect_left(r.s, x) for x in (-2, 3, 4, 99)]


def test_long_bodies_are_cut(spark):
    df = spark.createDataFrame([("d", "[PAGE 1]\n" + "x " * 5000)], "doc string, marked string")
    assert max(len(r.body) for r in chunking.chunk_bodies(df, ["doc"], 8192, 0).collect()) <= 8192


def test_windows_are_checked_after_clamping():
    assert chunking.check_window(10_000, 100) == (8192, 8092)
    for bad in ((0, 0), (10, -1), (10, 10), (10_000, 8192)):
        with pytest.raises(ValueError):
            chunking.check_window(*bad)


def test_marked_text(spark):
    df = spark.createDataFrame([("d", 2, "b"), ("d", 1, "a")], "doc string, page int, text string")
    assert chunking.marked_text(df, ["doc"]).first().marked == "[PAGE 1]\na\n\n[PAGE 2]\nb\n"
    assert chunking.windows(chunking.marked_text(df, ["doc"]).where(F.lit(False))).count() == 0
