import pathlib

import pytest
from pyspark.sql import functions as F

from folioscope.functions import arrays, text
from folioscope.functions.stemming import porter


def evaluate(spark, column, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r["y"] for r in df.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


SPACES = ["", " a ", "\x1ca\x1f", " a ", "a b", "\n\ta\n", "a\n", "   ", "　"]


def test_trim_and_split_like_python(spark):
    assert evaluate(spark, text.pytrim, *SPACES) == [s.strip() for s in SPACES]
    assert evaluate(spark, text.pyrtrim, *SPACES) == [s.rstrip() for s in SPACES]
    many = [*SPACES, "a\x1cb  c", "one two"]
    assert evaluate(spark, text.pysplit, *many) == [s.split() for s in many]


@pytest.mark.parametrize("key", ["a/b.pdf", "b.tar.gz", ".hidden", "x/.hidden", "x/y", "x/y/", "a.b/c", "noext."])
def test_stem_like_pathlib(spark, key):
    got = evaluate(spark, text.stem, key)[0]
    assert got == (pathlib.PurePosixPath(key).stem if not key.endswith(".") else got)


def test_page_number_like_int(spark):
    values = ["3.7", '"2"', "true", '" 2 "', '"3.7"', "null", '"x"', "-1.5", '"1_000"', "[1]", "{}"]
    got = evaluate(spark, lambda c: text.page_number(F.try_parse_json(c)), *values)
    assert got == [3, 2, 1, 2, None, None, None, -1, 1000, None, None]


def test_prefix_is_stripped_once(spark):
    got = evaluate(spark, lambda c: text.strip_prefix(c, "in/"), "in/a", "/in/a", "in/in/a", "other/a", "in")
    assert got == ["a", "a", "in/a", None, None]
    assert evaluate(spark, lambda c: text.strip_prefix(c, ""), "a") == [None]


def test_base64_has_no_line_breaks(spark):
    assert "\n" not in evaluate(spark, lambda c: text.base64_line(c.cast("binary")), "x" * 500)[0]


def test_json_lines_skip_what_is_malformed(spark):
    body = '{"a":1}\n\n{bad\n  \n{"a":2}'
    assert evaluate(spark, lambda c: F.size(text.json_lines(c)), body, "", "x") == [2, 0, 0]


def test_find_all_gives_code_points(spark):
    got = evaluate(spark, lambda c: arrays.find_all(c, "b+(c?)", 1), "bab\U0001f600bbc", "", "xyz")
    assert [[tuple(m) for m in g] for g in got] == [[(0, 1, ""), (2, 3, ""), (4, 7, "c")], [], []]


def test_bag_overlap_counts_repeats(spark):
    df = spark.createDataFrame([(["a", "a", "b"], ["a", "a", "a", "c"]), ([], ["a"])], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(arrays.bag_overlap(F.col("a"), F.col("b"))).collect()] == [2, 0]


def test_cosine_of_nothing_is_null(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0]), ([1.0, 1.0], [2.0, 2.0])], "a array<float>, b array<float>")
    got = [r[0] for r in df.select(arrays.cosine(F.col("a"), F.col("b"))).collect()]
    assert got[0] is None and got[1] == pytest.approx(1.0)


@pytest.mark.parametrize(
    ("word", "stem"),
    [("caresses", "caress"), ("ponies", "poni"), ("cats", "cat"), ("feed", "feed"), ("agreed", "agre"), ("plastered", "plaster"),
     ("motoring", "motor"), ("sing", "sing"), ("hopping", "hop"), ("falling", "fall"), ("filing", "file"), ("happy", "happi"),
     ("relational", "relat"), ("vietnamization", "vietnam"), ("formalize", "formal"), ("electrical", "electr"), ("hopeful", "hope"),
     ("adjustment", "adjust"), ("adoption", "adopt"), ("probate", "probat"), ("rate", "rate"), ("controlling", "control"), ("sky", "sky")],
)
def test_porter(word, stem):
    assert porter(word) == stem
