"""Chat formatting with linked tool calls (operator 4, native).

Input: messages (conv_id, turn, role, text). An assistant message may carry
calls and a tool message a result, as JSON in text:
{"content": ..., "tool_calls": [{"id", "name", "arguments"}]} and
{"tool_call_id": ..., "content": ...}. Arguments may name earlier results by
the string "$ref:<id>".

Calls and results are hash-joined on (conversation, identifier); a result needs
its call, and a call needs the results it refers to. A message is placed after
all it depends on: order_turn is the largest turn among it and its ancestors.
Where a message is later than what it depends on, as it should be, that is its own
turn, so nothing needs doing; only turns that stand the wrong way round are carried on along
the dependencies, each round writing just what it changed. Dependencies within one
order_turn are then peeled topologically: order_depth is the level, and what is
never ready hangs on a cycle and is marked so. Sorting a
conversation by (order_turn, order_depth, turn) is a topological order.
Arguments are checked against schemas (parameter, type, required), and each
message is serialised as canonical JSON: sorted keys, no spaces, normalised
numbers.

One row goes in and one comes out per message; conversations are never gathered
into one row, so a conversation that holds a third of all turns is nothing special.

Defined cases: null text is the empty string; a null or unknown role is kept in
lower case ("" if null); text that isn't such JSON (white space may come first) is plain
content; messages with a null conv_id form a conversation of their own, and a null
turn is before all others; both are left out of the JSON; of calls
with one identifier in a conversation, the first by turn gets the results; a
result without a call is "unlinked"; repeated rows are one message as far as links and
counts go, and all are returned; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.llm.common import Work

_PAYLOAD = "content string, tool_calls array<struct<id:string,name:string,arguments:string>>, tool_call_id string"
SCHEMA_TYPE = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("param", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("required", T.BooleanType()),
    ]
)
#: JSON schema type -> what the type of a value must match. Fixed values.
TYPES = {
    "string": "^STRING$",
    "integer": "^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL\\([0-9]+,0\\))$",
    "number": "^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL.*|DOUBLE|FLOAT)$",
    "boolean": "^BOOLEAN$",
    "array": "^ARRAY",
    "object": "^OBJECT",
}


def _key() -> Column:
    """What stands for a conversation in joins: never null, and that of null is like no other."""
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))


def _read(messages: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    role = F.lower(F.trim(F.coalesce(F.col("role"), F.lit(""))))
    parsed = F.when(role.isin("assistant", "tool") & text.rlike("^\\s*\\{"), F.from_json(text, _PAYLOAD))
    out = messages.select("conv_id", _key().alias("_k"), "turn", role.alias("role"), text.alias("text"), parsed.alias("p"))
    has_calls = (F.col("role") == "assistant") & (F.size(F.coalesce("p.tool_calls", F.array())) > 0)
    is_result = (F.col("role") == "tool") & F.col("p.tool_call_id").isNotNull()
    return out.select(
        "conv_id",
        "_k",
        "turn",
        "role",
        F.when(has_calls | is_result, F.coalesce("p.content", F.lit(""))).otherwise(F.col("text")).alias("content"),
        F.when(has_calls, F.col("p.tool_calls")).alias("calls"),
        F.when(is_result, F.col("p.tool_call_id")).alias("result_of"),
        F.xxhash64("role", "text").alias("row"),
    )


def _problems(calls: DataFrame, schemas: DataFrame | None) -> DataFrame:
    """calls with args (canonical JSON or null) and errors (sorted array of strings)."""
    given = F.from_json("arguments", "map<string,variant>")
    out = calls.withColumns({"given": given, "args": F.to_json(F.try_parse_json("arguments"))})
    if schemas is None:
        errors = F.when(F.col("given").isNull(), F.array(F.lit("arguments"))).otherwise(F.array().cast("array<string>"))
        return out.withColumn("errors", errors).drop("given")
    specs = schemas.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("param", "type", "required"))).alias("spec"))

    def of(s: Column) -> Column:
        value = F.try_element_at("given", s["param"])
        kind = F.schema_of_variant(value)
        fits = F.lit(False)
        for name, pattern in TYPES.items():
            fits = fits | ((s["type"] == name) & kind.rlike(pattern))
        return (
            F.when(value.isNull(), F.when(s["required"], F.concat(F.lit("missing:"), s["param"])))
            .when(~fits, F.concat(F.lit("type:"), s["param"]))
        )

    checked = F.concat(
        F.filter(F.transform("spec", of), lambda x: x.isNotNull()),
        F.transform(
            F.array_except(F.map_keys("given"), F.transform("spec", lambda s: s["param"])), lambda k: F.concat(F.lit("extra:"), k)
        ),
    )
    return (
        out.join(specs, "name", "left")
        .withColumn(
            "errors",
            F.sort_array(
                F.when(F.col("spec").isNull(), F.array(F.lit("tool"))).when(F.col("given").isNull(), F.array(F.lit("arguments"))).otherwise(checked)
            ),
        )
        .drop("given", "spec")
    )


def _raised(edges: DataFrame, work: Work) -> DataFrame | None:
    """(_k, node, t): order turns of nodes that have an ancestor with a later turn. None if there are none."""
    rounds = [work.save(edges.where("ts > td").groupBy("_k", F.col("dst").alias("node")).agg(F.max("ts").alias("t")), "raised0")]
    while not rounds[-1].isEmpty():
        so_far = rounds[0]
        for r in rounds[1:]:
            so_far = so_far.unionByName(r)
        best = so_far.groupBy("_k", F.col("node").alias("dst")).agg(F.max("t").alias("held"))
        reached = (
            edges.join(rounds[-1].withColumnRenamed("node", "src"), ["_k", "src"])
            .groupBy("_k", "dst", "td")
            .agg(F.max("t").alias("t"))
            .join(best, ["_k", "dst"], "left")
            .where(F.col("t") > F.greatest("td", "held"))
        )
        rounds.append(work.save(reached.select("_k", F.col("dst").alias("node"), "t"), f"raised{len(rounds)}"))
    return best.withColumnRenamed("dst", "node").withColumnRenamed("held", "t") if len(rounds) > 1 else None


def _levels(edges: DataFrame, work: Work) -> DataFrame:
    """(_k, node, raised, order_depth, cyclic) of nodes that have a place other than their own turn, level 0.

    edges: (_k, src, dst, ts, td), with the turns of both ends.
    """
    none = edges.select("_k", F.col("src").alias("node"), F.col("ts").alias("raised"), F.lit(0).alias("order_depth"), F.lit(False).alias("cyclic")).limit(0)
    raised = _raised(edges, work)
    if raised is None:
        tight = edges.where("ts = td").select("_k", "src", "dst")
    else:
        at = lambda end: raised.select("_k", F.col("node").alias(end), F.col("t").alias(f"r_{end}"))
        both = edges.join(at("src"), ["_k", "src"], "left").join(at("dst"), ["_k", "dst"], "left")
        tight = both.where(F.coalesce("r_src", "ts") == F.coalesce("r_dst", "td")).select("_k", "src", "dst")
    tight = work.save(tight, "tight")
    if raised is None and tight.isEmpty():
        return none
    node = lambda end: tight.select("_k", F.col(end).alias("node"))
    waiting = work.save(node("dst").groupBy("_k", "node").agg(F.count(F.lit(1)).alias("open")), "waiting0")
    ready = work.save(node("src").distinct().join(waiting, ["_k", "node"], "left_anti").withColumn("order_depth", F.lit(0)), "ready0")
    placed, step = ready, 0
    while not ready.isEmpty():
        step += 1
        met = tight.join(ready.select("_k", F.col("node").alias("src")), ["_k", "src"]).groupBy("_k", F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("met"))
        left = work.save(waiting.join(met, ["_k", "node"], "left").select("_k", "node", (F.col("open") - F.coalesce("met", F.lit(0))).alias("open")), f"left{step}")
        ready = work.save(left.where("open = 0").select("_k", "node", F.lit(step).alias("order_depth")), f"ready{step}")
        waiting = left.where("open > 0")
        placed = placed.unionByName(ready)
    placed = placed.withColumn("cyclic", F.lit(False)).unionByName(waiting.select("_k", "node", F.lit(0).alias("order_depth"), F.lit(True).alias("cyclic")))
    if raised is None:
        return placed.select("_k", "node", F.lit(None).cast(none.schema["raised"].dataType).alias("raised"), "order_depth", "cyclic")
    out = placed.join(raised.withColumnRenamed("t", "raised"), ["_k", "node"], "full")
    return out.select("_k", "node", "raised", F.coalesce("order_depth", F.lit(0)).alias("order_depth"), F.coalesce("cyclic", F.lit(False)).alias("cyclic"))


def format_chats(messages: DataFrame, schemas: DataFrame | None = None) -> DataFrame:
    """One row per message: conv_id, turn, role, order_turn, order_depth, link, n_calls, n_invalid, json.

    link: "none", "call", "result", "unlinked" (a result whose call is missing)
    or "cycle". schemas: rows of SCHEMA_TYPE, or None to check only that
    arguments are JSON objects.
    """
    spark = messages.sparkSession
    read = _read(messages)
    work = Work(spark, "chat")
    linked = work.save(read.where(F.col("calls").isNotNull() | F.col("result_of").isNotNull()), "linked")
    node = F.concat_ws(":", F.col("turn").cast("string"), F.col("row").cast("string"))
    at = F.coalesce(F.col("turn").cast("bigint"), F.lit(-(2**63))).alias("at")
    once = linked.select("_k", node.alias("node"), "turn", at, "calls", "result_of").dropDuplicates(["_k", "node"])
    calls = once.where("calls is not null").select("_k", "at", "node", F.posexplode("calls").alias("ix", "c")).select("_k", "at", "node", "ix", "c.*")
    owner = calls.where("id is not null").groupBy("_k", "id").agg(F.min(F.struct("at", "ix", "node")).alias("o")).select("_k", "id", "o.node", "o.at")
    results = once.where("result_of is not null").select("_k", "at", "node", F.col("result_of").alias("id"))
    end = lambda df, name, t: df.withColumnsRenamed({"node": name, "at": t})
    to_result = end(results, "dst", "td").join(end(owner, "src", "ts"), ["_k", "id"]).drop("id")
    needs = calls.select("_k", "at", "node", F.explode(F.regexp_extract_all("arguments", F.lit('"\\$ref:([^"]+)"'), F.lit(1))).alias("id"))
    to_call = end(needs, "dst", "td").join(end(results, "src", "ts"), ["_k", "id"]).drop("id")
    edges = work.save(to_result.unionByName(to_call).distinct(), "edges")
    placed = _levels(edges, work)
    checked = (
        _problems(calls, schemas)
        .groupBy("_k", "node")
        .agg(F.sort_array(F.collect_list(F.struct("ix", "id", "name", "args", "arguments", "errors"))).alias("all"))
        .select(
            "_k",
            "node",
            F.transform(
                "all",
                lambda x: F.concat(
                    F.lit('{"arguments":'),
                    F.coalesce(x["args"], F.to_json(F.struct(x["arguments"].alias("v"))).substr(F.lit(5), F.length(F.to_json(F.struct(x["arguments"].alias("v")))) - 5), F.lit("null")),
                    F.lit(',"errors":'),
                    F.to_json(x["errors"]),
                    F.lit(","),
                    F.to_json(F.struct(x["id"].alias("id"), x["name"].alias("name"))).substr(F.lit(2), F.lit(2**31 - 1)),
                ),
            ).alias("calls_json"),
            F.size(F.filter("all", lambda x: F.size(x["errors"]) > 0)).cast("bigint").alias("n_invalid"),
        )
    )
    has_call = to_result.select("_k", F.col("dst").alias("node"), F.lit(True).alias("found")).distinct()
    info = once.select("_k", "node").join(placed, ["_k", "node"], "left").join(checked, ["_k", "node"], "left").join(has_call, ["_k", "node"], "left")
    info = info.withColumnRenamed("node", "_n")
    # Only messages that carry calls or results meet `info`; the others never leave their partition.
    plain = read.where(F.col("calls").isNull() & F.col("result_of").isNull()).select(
        "conv_id",
        "turn",
        "role",
        F.col("turn").alias("order_turn"),
        F.lit(0).alias("order_depth"),
        F.lit("none").alias("link"),
        F.lit(0).cast("bigint").alias("n_calls"),
        F.lit(0).cast("bigint").alias("n_invalid"),
        F.to_json(F.struct("content", F.col("conv_id").alias("conversation"), "role", "turn")).alias("json"),
    )
    head = F.to_json(F.struct("content", F.col("conv_id").alias("conversation"), F.col("result_of").alias("result_of"), "role"))
    rich = (
        linked.withColumn("_n", node)
        .join(info, ["_k", "_n"])
        .select(
            "conv_id",
            "turn",
            "role",
            F.coalesce(F.col("raised").cast(linked.schema["turn"].dataType), "turn").alias("order_turn"),
            F.coalesce("order_depth", F.lit(0)).alias("order_depth"),
            F.when(F.col("cyclic"), "cycle")
            .when(F.col("calls").isNotNull(), "call")
            .when(F.col("found"), "result")
            .otherwise("unlinked")
            .alias("link"),
            F.coalesce(F.size("calls").cast("bigint") * F.col("calls").isNotNull().cast("bigint"), F.lit(0).cast("bigint")).alias("n_calls"),
            F.coalesce("n_invalid", F.lit(0).cast("bigint")).alias("n_invalid"),
            F.concat(
                head.substr(F.lit(1), F.length(head) - 1),
                F.when(F.col("calls_json").isNotNull(), F.concat(F.lit(',"tool_calls":['), F.array_join("calls_json", ","), F.lit("]"))).otherwise(""),
                F.coalesce(F.concat(F.lit(',"turn":'), F.col("turn").cast("string")), F.lit("")),
                F.lit("}"),
            ).alias("json"),
        )
    )
    return plain.unionByName(rich)


#: Schemas of the query's tools: (tool, parameter, type, required). Fixed values.
TOOLS = [("add", "a", "number", True), ("add", "b", "number", True), ("search", "limit", "integer", False), ("search", "query", "string", True)]


def with_tool_messages(conversations: DataFrame) -> DataFrame:
    """conversations, at four times their turns, with a call and a result after every message of the assistant.

    The given tables hold no tool messages, so these are made, from conv_id and turn alone. Their kind is
    (conv_id + turn) % 8: 0 a valid search, 1 one without its query, 2 one whose limit is a text, 3 an unknown
    tool, 4 a result of another call, 5 a result before its call, 6 a sum that refers to the result before, 7 a call whose
    arguments are no object. Arguments come with their keys out of order.
    """
    kind, t = F.pmod(F.col("conv_id") + F.col("turn"), F.lit(8)), F.col("turn").cast("string")
    arguments = (
        F.when(kind == 1, F.concat(F.lit('{"limit": '), t, F.lit("}")))
        .when(kind == 2, F.concat(F.lit('{"query": "q'), t, F.lit('", "limit": "'), t, F.lit('"}')))
        .when(kind == 6, F.concat(F.lit('{"b": 1.5, "a": "$ref:c'), (F.col("turn") - 2).cast("string"), F.lit('"}')))
        .when(kind == 7, F.lit("[1]"))
        .otherwise(F.concat(F.lit('{"query": "q'), t, F.lit('", "limit": '), t, F.lit("}")))
    )
    name = F.when(kind == 3, "fly").when(kind == 6, "add").otherwise("search")
    call = F.concat(F.lit('{"content": "", "tool_calls": [{"id": "c'), t, F.lit('", "name": "'), name, F.lit('", "arguments": '), arguments, F.lit("}]}"))
    result = F.concat(F.lit('{"tool_call_id": "'), F.when(kind == 4, "x").otherwise("c"), t, F.lit('", "content": "r'), t, F.lit('"}'))
    own, late = 4 * F.col("turn"), F.when(kind == 5, 1).otherwise(0)
    rows = F.array(
        F.struct(own.alias("turn"), F.col("role").alias("role"), F.col("text").alias("text")),
        F.struct((own + 1 + late).alias("turn"), F.lit("assistant").alias("role"), call.alias("text")),
        F.struct((own + 2 - late).alias("turn"), F.lit("tool").alias("role"), result.alias("text")),
    )
    made = F.when(F.lower(F.trim("role")) == "assistant", rows).otherwise(F.slice(rows, 1, 1))
    return conversations.select("conv_id", F.explode(made).alias("m")).select("conv_id", "m.*")


def op4_chat_format(spark, sf_dir: str) -> DataFrame:
    messages = with_tool_messages(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    rows = F.array(*[F.struct(*[F.lit(v).alias(f.name) for v, f in zip(tool, SCHEMA_TYPE, strict=True)]) for tool in TOOLS])
    return format_chats(messages, spark.range(1).select(F.inline(rows)))  # made on the JVM side


OP4_SQL = """
WITH c AS (
  SELECT conv_id, turn AS t, lower(trim(coalesce(role, ''))) AS role, coalesce(text, '') AS text, (conv_id + turn) % 8 AS kind FROM conversations
), a AS (
  SELECT *, CASE kind
      WHEN 1 THEN '{"limit":' || t || '}'
      WHEN 2 THEN '{"limit":"' || t || '","query":"q' || t || '"}'
      WHEN 6 THEN '{"a":"$ref:c' || (t - 2) || '","b":1.5}'
      WHEN 7 THEN '[1]'
      ELSE '{"limit":' || t || ',"query":"q' || t || '"}' END AS args,
    CASE kind WHEN 3 THEN 'fly' WHEN 6 THEN 'add' ELSE 'search' END AS name,
    CASE kind WHEN 1 THEN '"missing:query"' WHEN 2 THEN '"type:limit"' WHEN 3 THEN '"tool"' WHEN 6 THEN '"type:a"' WHEN 7 THEN '"arguments"' ELSE '' END AS errors
  FROM c WHERE role = 'assistant'
)
SELECT conv_id, 4 * t AS turn, role, 4 * t AS order_turn, CAST(0 AS INT) AS order_depth, 'none' AS link, CAST(0 AS BIGINT) AS n_calls, CAST(0 AS BIGINT) AS n_invalid,
  CAST(to_json({'content': text, 'conversation': conv_id, 'role': role, 'turn': 4 * t}) AS VARCHAR) AS json FROM c
UNION ALL
SELECT conv_id, 4 * t + CASE kind WHEN 5 THEN 2 ELSE 1 END, 'assistant', 4 * t + CASE kind WHEN 5 THEN 2 ELSE 1 END, 0, 'call', 1, CASE errors WHEN '' THEN 0 ELSE 1 END,
  '{"content":"","conversation":' || conv_id || ',"role":"assistant","tool_calls":[{"arguments":' || args || ',"errors":[' || errors || '],"id":"c' || t || '","name":"' || name
    || '"}],"turn":' || (4 * t + CASE kind WHEN 5 THEN 2 ELSE 1 END) || '}' FROM a
UNION ALL
SELECT conv_id, 4 * t + CASE kind WHEN 5 THEN 1 ELSE 2 END, 'tool', 4 * t + 2, CASE kind WHEN 5 THEN 1 ELSE 0 END, CASE kind WHEN 4 THEN 'unlinked' ELSE 'result' END, 0, 0,
  '{"content":"r' || t || '","conversation":' || conv_id || ',"result_of":"' || CASE kind WHEN 4 THEN 'x' ELSE 'c' END || t || '","role":"tool","turn":'
    || (4 * t + CASE kind WHEN 5 THEN 1 ELSE 2 END) || '}' FROM a
"""
