"""Secret scan: fixed patterns plus sliding-window entropy (operator 8, native).

Three base patterns give spans: assign (a credential word, then a value of 12
or more characters), access (AKIA keys of 18 or more) and hex (runs of 16 or
more). Matches are leftmost and non-overlapping per kind; a match whose value is
too short is dropped, and its characters stay consumed.

Beyond these, every run of 20 or more key characters is a candidate. A fold
over its characters keeps the counts of the current 20-character window, adding
one character and removing one per step, and with them the window's Shannon
entropy; the highest is compared with the threshold of the candidate's character
class (hex digits, one letter case with digits, both cases with digits). Candidates
on the allow list are suppressed; base spans never are.

Positions are code points of the whole text, end exclusive. All of it is
expressions within the row: no shuffle, no limit on length or number of spans.

Defined cases: a null text is an empty one and has no spans; repeated rows are
each scanned; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.arrays import find_all, let

# The patterns of the three base kinds and the shortest value of each.
KINDS = ["assign", "access", "hex", "entropy"]
ASSIGN = "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
SHORTEST = {"assign": 12, "access": 18, "hex": 16}

WINDOW = 20
CANDIDATE = f"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
#: Bits per character above which a window counts as random, by character class.
THRESHOLDS = {"hex": 3.0, "single": 3.6, "mixed": 3.9}
#: Candidates that match one of these are not reported by the entropy rule.
ALLOW = [
    "^[0-9+/_=-]*$",  # no letter: numbers, dates, rules
    "^[A-Za-z+/_=-]*$",  # no digit: words, paths
    "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # UUID
    "(?i)(example|sample|dummy|placeholder|changeme|abcdefghij|0123456789)",
]

_SPANS = "array<struct<s:int,e:int,v:string>>"


def find(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches as (s, e, v): start, end and the group's text. Work grows as n log n with the number of matches."""
    return F.transform(find_all(text, pattern, group), lambda m: F.struct(m["pos"].alias("s"), m["end"].alias("e"), m["value"].alias("v")))


def _none() -> Column:
    return F.array().cast(_SPANS)


def _xlog(c: Column) -> Column:
    return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))


def peak_entropy(value: Column) -> Column:
    """Highest Shannon entropy of any WINDOW-character window of a candidate."""
    index = lambda ch: F.instr(F.lit(ALPHABET), ch)  # noqa: E731  1-based, 0 for none

    def fold(codes: Column) -> Column:
        zero = F.struct(
            F.array_repeat(F.lit(0), len(ALPHABET) + 1).alias("n"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"), F.lit(0).alias("i")
        )

        def step(acc: Column, a: Column) -> Column:
            full = acc["i"] >= WINDOW
            r = F.when(full, F.get(codes, F.greatest(acc["i"] - WINDOW, F.lit(0)))).otherwise(F.lit(-1))
            more = F.get(acc["n"], a)
            less = F.coalesce(F.get(acc["n"], r), F.lit(0)) + (a == r).cast("int")
            total = acc["sum"] - _xlog(more) + _xlog(more + 1) - F.when(full, _xlog(less) - _xlog(less - 1)).otherwise(F.lit(0.0))
            n = F.transform(acc["n"], lambda c, j: c + (j == a).cast("int") - (j == r).cast("int"))
            h = F.when(acc["i"] >= WINDOW - 1, F.lit(math.log2(WINDOW)) - total / WINDOW).otherwise(F.lit(0.0))
            return F.struct(n.alias("n"), total.alias("sum"), F.greatest(acc["best"], h).alias("best"), (acc["i"] + 1).alias("i"))

        return F.aggregate(codes, zero, step, lambda acc: acc["best"])

    return let(F.transform(F.filter(F.split(value, ""), lambda x: x != ""), index), fold)


def _random(value: Column) -> Column:
    allowed = F.lit(False)
    for p in ALLOW:
        allowed = allowed | value.rlike(p)
    threshold = (
        F.when(value.rlike("^[0-9a-f]+$") | value.rlike("^[0-9A-F]+$"), THRESHOLDS["hex"])
        .when(value.rlike("[a-z]") & value.rlike("[A-Z]"), THRESHOLDS["mixed"])
        .otherwise(THRESHOLDS["single"])
    )
    return F.when(allowed, False).otherwise(peak_entropy(value) >= threshold)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, assign, access, hex, entropy): arrays of (s, e, v) spans over each whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    long_enough = lambda kind: lambda x: F.char_length(x["v"]) >= SHORTEST[kind]
    return docs.select(
        "doc_id",
        # The first test of each only spares texts in which nothing can match.
        F.when(text.rlike(ASSIGN), F.filter(find(text, ASSIGN, 2), long_enough("assign"))).otherwise(_none()).alias("assign"),
        F.when(F.contains(text, F.lit("AKIA")), F.filter(find(text, ACCESS), long_enough("access"))).otherwise(_none()).alias("access"),
        F.when(text.rlike("[0-9a-f]{16}"), find(text, "[0-9a-f]{16,}")).otherwise(_none()).alias("hex"),
        F.when(text.rlike(f"[A-Za-z0-9+/_=-]{{{WINDOW}}}"), F.filter(find(text, CANDIDATE), lambda x: _random(x["v"]))).otherwise(_none()).alias("entropy"),
    )


def joined_spans(kinds: list[str]) -> Column:
    """kind:start:end of the named columns by start, then kind, comma-joined."""
    def ranked(k: str) -> Column:
        return F.transform(F.col(k), lambda x: F.struct(x["s"].alias("s"), F.lit(KINDS.index(k)).alias("k"), x["e"].alias("e")))

    parts = [ranked(k) for k in kinds]
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(F.sort_array(F.concat(*parts)), lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ","
    )


def op8_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    n = lambda k: F.size(k).cast("bigint").alias(f"n_{k}")
    return scan(docs).select(
        "doc_id",
        n("assign"),
        n("access"),
        n("hex"),
        F.sha2(joined_spans(KINDS[:3]), 256).alias("base_sha256"),
        joined_spans(KINDS).alias("spans"),
    )


def _sql_spans(name: str, pattern: str, group: int, keep: str) -> str:
    """A table of spans in SQL: positions are sums over the lengths of gaps and matches before."""
    p = pattern.replace("'", "''")
    return f"""{name}_m AS (
  SELECT doc_id, string_split_regex(t, '{p}') AS gaps, regexp_extract_all(t, '{p}') AS ms, regexp_extract_all(t, '{p}', {group}) AS vs FROM d
), {name} AS (
  SELECT doc_id, s, s + length(m) AS e, v FROM (
    SELECT doc_id, ms[i] AS m, vs[i] AS v, list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS s
    FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM {name}_m)) WHERE {keep}
)"""


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _op8_sql() -> str:
    names = "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    assign = f"({names})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    spans = [
        _sql_spans("assign", assign, 2, f"length(v) >= {SHORTEST['assign']}"),
        _sql_spans("access", ACCESS, 0, f"length(v) >= {SHORTEST['access']}"),
        _sql_spans("hex", HEX, 0, f"length(v) >= {SHORTEST['hex']}"),
        _sql_spans("candidate", CANDIDATE, 0, " AND ".join(f"NOT regexp_matches(v, '{p}')" for p in ALLOW)),
    ]
    kinds = " UNION ALL ".join(f"SELECT doc_id, {i} AS k, '{k}' AS kind, s, e FROM {k}" for i, k in enumerate(KINDS))
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), {", ".join(spans)}, entropy AS (
  SELECT doc_id, s, e FROM (SELECT doc_id, s, e, v, unnest(range(1, length(v) - {WINDOW} + 2)) AS j FROM candidate) GROUP BY doc_id, s, e, v
  HAVING max(list_aggregate(string_split(substr(v, CAST(j AS BIGINT), {WINDOW}), ''), 'entropy')) >=
    CASE WHEN regexp_matches(v, '^[0-9a-f]+$') OR regexp_matches(v, '^[0-9A-F]+$') THEN {THRESHOLDS["hex"]}
      WHEN regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]') THEN {THRESHOLDS["mixed"]} ELSE {THRESHOLDS["single"]} END
), spans AS ({kinds}), base AS (
  SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k, e) FILTER (k < 3) AS b, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k, e) AS a
  FROM spans GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans
FROM d LEFT JOIN base ON base.doc_id = d.doc_id"""


OP8_SQL = _op8_sql()
