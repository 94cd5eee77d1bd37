import json

from llm_oracle import compare
from pyspark.sql import functions as F

from folioscope.llm import chat_format as cf

COLUMNS = "conv_id long, turn long, role string, text string, node string, row long, link string, id string"


def chats(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], COLUMNS)


def call(*calls, content=""):
    return json.dumps({"content": content, "tool_calls": [{"id": i, "name": n, "arguments": a} for i, n, a in calls]})


def result(call_id, content):
    return json.dumps({"tool_call_id": call_id, "content": content})


def schemas(spark):
    rows = [("add", "a", "number", True), ("add", "b", "integer", True), ("add", "note", "string", False), ("find", "q", "string", True), ("find", "opts", "object", False)]
    return spark.createDataFrame(rows, cf.SCHEMA_TYPE)


ROWS = [
    (1, 0, "User", "hello"),
    (1, 1, "assistant", call(("c1", "add", {"b": 2, "a": 1.5}), content="adding")),
    (1, 2, "tool", result("c1", "3.5")),
    (1, 3, "assistant", call(("c2", "find", {"q": "$ref:c1", "opts": {"z": 1, "a": []}}), ("c3", "nope", {}))),
    (1, 4, "tool", result("c9", "lost")),
    (2, 0, "tool", result("late", "before its call")),
    (2, 5, "assistant", call(("late", "add", {"a": "x", "c": 1}))),
    (3, 0, "assistant", call(("p", "find", {"q": "$ref:q"}))),
    (3, 1, "tool", result("p", "1")),
    (3, 2, "assistant", call(("q", "find", {"q": "$ref:p"}))),
    (3, 3, "tool", result("q", "2")),
    (4, 0, "assistant", "{not json"),
    (4, 1, None, None),
    (4, 1, None, None),
    (4, 2, "assistant", json.dumps({"tool_calls": [{"id": "s", "name": "find", "arguments": "[1]"}]})),
]


def test_links_order_and_validation(spark):
    out = cf.format_chats(chats(spark, ROWS), schemas(spark))
    got = {(r.conv_id, r.turn): r for r in out.collect()}
    assert out.count() == len(ROWS)
    assert {k: r.link for k, r in got.items() if r.link != "none"} == {
        (1, 1): "call", (1, 2): "result", (1, 3): "call", (1, 4): "unlinked", (2, 0): "result", (2, 5): "call",
        (3, 0): "cycle", (3, 1): "cycle", (3, 2): "cycle", (3, 3): "cycle", (4, 2): "call",
    }
    order = lambda c, t: (got[c, t].order_turn, got[c, t].order_depth, t)
    assert order(1, 1) < order(1, 2) < order(1, 3) and order(2, 5) < order(2, 0)
    assert got[1, 1].n_invalid == 0 and got[1, 3].n_invalid == 1 and got[2, 5].n_invalid == 1
    first = json.loads(got[1, 1].json)["tool_calls"][0]
    assert first == {"arguments": {"a": 1.5, "b": 2}, "errors": [], "id": "c1", "name": "add"}
    assert json.loads(got[2, 5].json)["tool_calls"][0]["errors"] == ["extra:c", "missing:b", "type:a"]
    assert [c["errors"] for c in json.loads(got[1, 3].json)["tool_calls"]] == [[], ["tool"]]
    assert json.loads(got[4, 2].json)["tool_calls"][0]["errors"] == ["arguments"]


def test_json_is_canonical(spark):
    for r in cf.format_chats(chats(spark, ROWS), schemas(spark)).collect():
        again = json.dumps(json.loads(r.json), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        assert r.json == again


def test_without_schemas_and_empty(spark):
    df = chats(spark, ROWS)
    assert {r.conv_id: r.n_invalid for r in cf.format_chats(df).where("link = 'call'").collect()} == {1: 0, 2: 0, 4: 1}
    assert cf.format_chats(df.limit(0)).count() == 0


def test_nulls_and_repeated_rows_are_whole(spark):
    rows = [
        (None, 0, "assistant", call(("n", "add", {"a": 1, "b": 2}))),
        (None, 1, "tool", "  \n" + result("n", "3")),
        (None, None, "tool", result("n", "4")),
        (5, 0, "assistant", call(("x", "add", {"a": "one"}))),
        (5, 0, "assistant", call(("x", "add", {"a": "one"}))),
        (5, 1, "tool", result("x", "?")),
        (5, 1, "tool", result("x", "?")),
        (6, 3, "tool", result("n", "of another conversation")),
    ]
    got = sorted(((r.conv_id, r.turn, r.order_turn, r.order_depth, r.link, r.n_calls, r.n_invalid, r.json) for r in cf.format_chats(chats(spark, rows), schemas(spark)).collect()), key=str)
    assert len(got) == len(rows)
    assert [g[:7] for g in got] == sorted(
        [
            (None, 0, 0, 0, "call", 1, 0), (None, 1, 1, 0, "result", 0, 0), (None, None, 0, 1, "result", 0, 0),
            *[(5, 0, 0, 0, "call", 1, 1)] * 2, *[(5, 1, 1, 0, "result", 0, 0)] * 2, (6, 3, 3, 0, "unlinked", 0, 0),
        ],
        key=str,
    )
    assert all("conversation" in json.loads(g[7]) and "turn" in json.loads(g[7]) for g in got if None not in g[:2])


def test_long_traces_take_no_rounds_and_reversed_ones_do(spark, monkeypatch):
    def trace(conv, turns):
        out = []
        for i, (a, b) in enumerate(zip(turns[::2], turns[1::2], strict=True)):
            out += [(conv, a, "assistant", call((f"c{i}", "find", {"q": f"$ref:c{i - 1}"}))), (conv, b, "tool", result(f"c{i}", "r"))]
        return out

    saved = []
    keep = cf.Work.save
    monkeypatch.setattr(cf.Work, "save", lambda self, df, name: saved.append(name) or keep(self, df, name))
    out = cf.format_chats(chats(spark, trace(1, range(200)))).collect()
    assert all((r.order_turn, r.order_depth) == (r.turn, 0) for r in out) and len(saved) < 6
    out = cf.format_chats(chats(spark, trace(1, range(9, -1, -1)) + trace(2, [0, 1, 2, 3]))).collect()
    order = [r.turn for r in sorted(out, key=lambda r: (r.order_turn, r.order_depth, r.turn)) if r.conv_id == 1]
    assert order == list(range(9, -1, -1)) and {r.order_turn for r in out if r.conv_id == 1} == {9}
    assert all((r.order_turn, r.order_depth) == (r.turn, 0) for r in out if r.conv_id == 2)


def test_one_long_conversation(spark):
    df = spark.range(3000).select(F.lit(1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.lit("same").alias("text"))
    assert cf.format_chats(df).count() == 3000


def test_query_equals_sql(spark, sf_dir, duck):
    compare("op4_chat_format", spark, sf_dir, duck)
