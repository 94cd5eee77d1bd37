import hashlib
from collections import defaultdict

import pytest
from llm_oracle import compare
from pyspark.sql import functions as F

from folioscope.llm import line_dedup as ld

WS = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=20, min_docs=3):
    low = -(2**63)
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WS))
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(low if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == (low if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def run(df):
    out = ld.dedup_lines(df).select("doc_id", "_ld_lines", "_ld_dropped", F.sha2(F.coalesce("text", F.lit("")), 256))
    return sorted((tuple(r) for r in out.collect()), key=repr)


LINE = "This line is long enough to count."
ROWS = [
    (1, f"{LINE}\nown line of the first document\nshort"),
    (2, f"  {LINE.upper()}\t\nshort\n{LINE}"),
    (3, f"short\n{LINE}\n{LINE}"),
    (5, "É" * 25 + "\nx"),
    (6, "é" * 25 + "\n" + "É" * 25),
    (7, "É" * 25),
    (8, "in two only, so it stays as it is"),
    (9, "in two only, so it stays as it is"),
    (None, LINE),
    (10, None),
    (11, ""),
    (12, "\n\n"),
    (3, f"another text of three\n{LINE}"),
    (20, "\n".join(f"number {i} of many lines here" for i in range(200))),
    (21, "\n".join(f"number {i} of many lines here" for i in range(0, 200, 3))),
    (22, "\n".join(f"number {i} of many lines here" for i in range(199, -1, -2))),
    (22, "\n".join(f"number {i} of many lines here" for i in range(199, -1, -2))),
]


def test_against_brute_force(spark, frame_of):
    assert run(frame_of(ROWS)) == brute(ROWS)


def test_messy_and_empty(spark, messy, messy_rows, nothing):
    assert run(messy) == brute(messy_rows)
    assert run(nothing) == []


def test_hot_line(spark, frame_of):
    rows = [(i, f"{LINE}\nown line number {i} of document") for i in range(400)]
    assert run(frame_of(rows)) == brute(rows)


def test_other_columns_stay(spark, messy):
    assert set(messy.columns) < set(ld.dedup_lines(messy).columns)


def test_bitmaps_hold_no_text(spark, frame_of):
    assert dict(ld.line_bitmaps(frame_of(ROWS)).dtypes) == {
        "_ld_doc": "bigint", "_ld_row": "bigint", "_ld_dropped": "bigint", "_ld_keep": "array<struct<word:bigint,bits:bigint>>",
    }


def test_keep_bitmaps(spark, frame_of):
    """Bits of kept lines are ones, and words that are all ones aren't stored."""
    shared = [f"shared line number {i} of many" for i in range(300)]
    rows = [(i, "\n".join(shared[70:75] if i < 3 else [])) for i in range(3)] + [(0, "\n".join(shared))]
    got = {r["_ld_row"]: r for r in ld.line_bitmaps(frame_of(rows)).where("_ld_doc = 0").collect()}
    (whole,) = [r for r in got.values() if [w.word for w in r["_ld_keep"]] == [1]]
    assert {i for i in range(64) if not whole["_ld_keep"][0].bits >> i & 1} == {6, 7, 8, 9, 10} and whole["_ld_dropped"] == 5


def test_within_the_document_too(spark, frame_of):
    rows = [(1, LINE), (2, f"{LINE}\nx"), (3, f"a\n{LINE}\nb\n{LINE}\n{LINE.upper()}"), (3, f"a\n{LINE}\nb\n{LINE}\n{LINE.upper()}")]
    got = [(r.doc_id, r.text) for r in ld.dedup_lines(frame_of(rows), within_document=True).orderBy("doc_id").collect()]
    assert got == [(1, ""), (2, "x"), (3, f"a\n{LINE}\nb"), (3, f"a\n{LINE}\nb")]


def test_the_sorted_ranges_are_streamed_without_another_shuffle(spark, frame_of, monkeypatch):
    plans = {}
    keep = ld.Work.save

    def save(self, df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return keep(self, df, name)

    monkeypatch.setattr(ld.Work, "save", save)
    ld.line_bitmaps(frame_of(ROWS))
    assert plans["ranged"].count("Exchange") == 1 and "rangepartitioning" in plans["ranged"] and plans["ranged"].count("Window") >= 1


@pytest.mark.parametrize("name", ["op1_line_dedup"])
def test_query_equals_sql(name, spark, sf_dir, duck):
    compare(name, spark, sf_dir, duck)
