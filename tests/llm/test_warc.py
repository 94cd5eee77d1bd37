import base64
import gzip
import hashlib
import json

import pytest
from llm_oracle import compare
from pyspark.sql import functions as F

from folioscope.llm import warc

ROWS = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, "http://a/3", None), (4, "http://a/4", ""), (5, None, "ünï\r\n\r\nWARC/1.1\r\n"), (6, "http://a/\n6", "x" * 100_000),
        (2, "http://a/2", "same"), (1, "http://a/1", "same"), (None, "http://n", "same")]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "extra", b"z") for r in rows], "page_id long, url string, html string, record_type string, payload binary")


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("gz", [True, False])
def test_round_trip(spark, tmp_path, gz):
    path = str(tmp_path / "w")
    warc.write_warc(warc.to_records(pages(spark)), path, gzip=gz)
    got = warc.read_warc(spark, path).collect()
    assert len(got) == len(ROWS)
    texts = {f"urn:page:{i}": t or "" for i, _, t in ROWS if i is not None}
    assert all(r.date and r.record_id and r.headers["warc-record-id"] == f"<{r.record_id}>" for r in got)
    assert all(("warc-profile" in r.headers) == (r.record_type == "revisit") and r.headers["warc-payload-digest"].startswith("sha1:") for r in got)
    assert all((r.http_head or "").startswith("HTTP/1.1 200 OK") == (r.record_type == "response") for r in got)
    for r in got:
        if r.record_id in texts:
            assert r.payload_digest == sha(texts[r.record_id]) and r.payload_bytes == len(texts[r.record_id].encode())
            assert bytes(r.payload).decode() == (texts[r.record_id] if r.record_type == "response" else "")
    kinds = sorted((r.record_id if r.record_id in texts else "None", r.record_type, r.refers_to) for r in got)
    assert kinds == sorted(
        [("urn:page:1", "response", None)] * 2 + [("urn:page:2", "revisit", "urn:page:1")] * 2 + [("urn:page:3", "response", None), ("urn:page:4", "revisit", "urn:page:3"),
         ("urn:page:5", "response", None), ("urn:page:6", "response", None), ("None", "response", None)]
    )


def test_small_payloads_may_stay_whole(spark):
    kinds = {r.record_type for r in warc.to_records(pages(spark), min_bytes=5).collect()}
    assert kinds == {"response"}


def test_predicates_reach_the_reader(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_warc(warc.to_records(pages(spark)), path)
    hits = warc.read_warc(spark, path).where((F.col("record_type") == "revisit") & F.col("target_uri").startswith("http://a"))
    assert sorted(r.record_id for r in hits.collect()) == ["urn:page:2", "urn:page:2", "urn:page:4"]
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert " Filter " not in plan
    assert all(r.payload is None for r in warc.read_warc(spark, path, payload=False).collect())


def test_unwanted_records_are_not_decoded(tmp_path):
    head = "WARC/1.1\r\nWARC-Type: {}\r\nContent-Length: 4\r\n\r\n"
    (tmp_path / "x.warc").write_bytes(b"".join((head.format(k) + k[:4] + "\r\n\r\n").encode() for k in ("response", "metadata", "response")))
    reader = warc.WarcReader({"path": str(tmp_path)})
    reader.tests = [("record_type", "in", ("metadata",))]
    taken = []
    real = warc._Stream.take
    try:
        warc._Stream.take = lambda self, n: taken.append(n) or real(self, n)
        rows = [r for p in reader.partitions() for r in reader.read(p)]
    finally:
        warc._Stream.take = real
    assert len(rows) == 1 and taken == [4]


def rows_and_inflated(path, tests, payload="true"):
    """Records that a reader yields, and how many bytes its streams inflated."""
    reader, streams = warc.WarcReader({"path": str(path), "payload": payload}), []
    reader.tests = tests
    real = warc._Stream.__init__
    try:
        warc._Stream.__init__ = lambda self, *a: streams.append(self) or real(self, *a)
        rows = [r for p in reader.partitions() for r in reader.read(p)]
    finally:
        warc._Stream.__init__ = real
    return rows, sum(s.inflated for s in streams)


def test_unwanted_members_are_not_inflated(spark, tmp_path):
    big = [(i, "http://a", "".join(chr(33 + (i * 7919 + j * j) % 90) for j in range(200_000))) for i in range(6)]
    path = tmp_path / "w"
    warc.write_warc(warc.to_records(pages(spark, [*big, (7, "http://b", "tiny")])).coalesce(1), str(path))
    rows, inflated = rows_and_inflated(path, [("target_uri", "in", ("http://b",))])
    assert [bytes(r[-1]) for r in rows] == [b"tiny"] and inflated < 7 * 8192
    rows, inflated = rows_and_inflated(path, [("record_id", "starts", ("urn:page:",))], "false")
    assert len(rows) == 7 and inflated < 7 * 8192
    rows, inflated = rows_and_inflated(path, [])
    assert len(rows) == 7 and inflated > 6 * 200_000
    # Any gzip tool reads the members, and members without the extra field are skipped all the same.
    (name,) = [p for p in path.iterdir() if p.name.endswith(".warc.gz")]
    plain = gzip.decompress(name.read_bytes())
    assert plain.count(b"WARC-Type: response") == 7
    other = tmp_path / "other"
    other.mkdir()
    (other / "x.warc.gz").write_bytes(gzip.compress(plain[: len(plain) // 2]) + gzip.compress(plain[len(plain) // 2 :]))
    assert rows_and_inflated(other, [("target_uri", "in", ("http://b",))])[0][0][-1] == b"tiny"


def test_overwriting_removes_the_files_before(spark, tmp_path):
    path = tmp_path / "w"
    for _ in range(2):
        warc.register(spark)
        warc.to_records(pages(spark)).write.format("warc").mode("overwrite").save(str(path))
    listed = json.loads((path / "_manifest").read_text())
    assert sorted(p.name for p in path.iterdir() if p.name.endswith(".gz")) == sorted(listed)
    assert warc.read_warc(spark, str(path)).count() == len(ROWS)


def test_schemes():
    assert warc._fs("/a/b")[1] == "/a/b" and warc._fs("file:/a/b")[1] == "/a/b" and warc._fs("file:///a/b")[1] == "/a/b"
    with pytest.raises(ValueError, match="viewfs"):
        warc._fs("viewfs://x/y")
    assert warc.SAME_STORE["s3a"] == "s3"


def test_foreign_archives(spark, tmp_path):
    record = "WARC/1.0\r\nWARC-Type: response\r\nX-Folded: a\r\n  b\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n".encode()
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(record) + gzip.compress(record))
    (tmp_path / "b.warc").write_bytes(record)
    got = warc.read_warc(spark, str(tmp_path)).collect()
    assert [bytes(r.payload) for r in got] == [b"abc"] * 3 and got[0].headers["x-folded"] == "a b"
    (tmp_path / "h").mkdir()
    (tmp_path / "h" / "h.warc").write_bytes(b"WARC/1.0\r\nWARC-Type: response\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: 25\r\n\r\nHTTP/1.1 200 OK\r\n\r\nbody!\n\r\n\r\n")
    (h,) = warc.read_warc(spark, str(tmp_path / "h")).collect()
    assert (h.http_head, bytes(h.payload), h.payload_bytes) == ("HTTP/1.1 200 OK\r\n\r\n", b"body!\n", 6)
    (tmp_path / "c.warc").write_bytes(record[:-6])
    with pytest.raises(Exception, match="ends within a record"):
        warc.read_warc(spark, str(tmp_path)).collect()


def test_uncommitted_files_are_not_read(spark, tmp_path):
    path = tmp_path / "w"
    warc.write_warc(warc.to_records(pages(spark)), str(path))
    (path / "part-left-behind.warc.gz").write_bytes(b"broken")
    assert warc.read_warc(spark, str(path)).count() == len(ROWS)


def test_empty(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_warc(warc.to_records(pages(spark).limit(0)), path)
    assert warc.read_warc(spark, path).count() == 0


def test_query_equals_sql(spark, sf_dir, duck):
    compare("op6_warc", spark, sf_dir, duck)
