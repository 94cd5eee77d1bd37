"""Benchmark decontamination by templates (operator 5, native).

Texts are canonicalised: white space becomes single spaces, numbers, units after
numbers and capitalised words in mid-sentence become typed placeholders, case and
trailing punctuation go. Beside this template stand the literal tokens, whose
values are kept and only case and trailing punctuation go, so a copy is found
whatever its spacing and case. Each benchmark item gives the hashes of its
`window`-token windows in both forms (an item of `min_tokens` to `window` - 1
tokens gives one window, the whole item), and the windows of every document are
hash-joined with them. A hit aligns document and item; every window of the
alignment is then confirmed on the tokens themselves, each equal as template or
literally, and the values in its slots are compared, without case: within one
alignment of a document with an item, each value of the item must always stand
for one value of the document and the other way round. Windows that hold a value
which doesn't are no hits, unless all their tokens are equal. So both verbatim copies
and re-parameterised ones (other names and numbers, consistently put in) are
caught, and chance hits of a bare pattern aren't.

A document is contaminated if consistent alignments cover at least `coverage`
of some item's windows.

The benchmark's window hashes are counted first. Up to `broadcast_windows` of
them are broadcast, as hashes and nothing else (some 32 bytes each in Spark's hash table, so
at most 8 MB); beyond that a bitmap of fixed size takes their place, and the join that
follows is salted. Only hashes and positions are exploded, never text. Texts
of hit documents alone are read again and cut to the tokens of each alignment;
these meet the item's tokens in a salted join, as one passage may be in any
number of documents. Documents without hits are never shuffled.

Defined cases: a null or empty text has no windows and is clean; rows that share
a doc_id and a text are treated alike, and all are returned; items shorter than
min_tokens are never evidence; windows with fewer than half literal tokens are no
evidence of a template, so they are joined by their literal tokens only (equal
values) and count with other values only in an alignment that also holds a window
with more literal tokens: an item without any such window is found by copies with
equal values, not by re-parameterised ones; texts that share an item_id are items of their own; an empty benchmark
or empty documents give no hits. A text all in upper case has no names, so of it
only literal windows and those without names are found. A capitalised word at the start of an item or
sentence counts as a word, so with another name there the windows that hold it aren't covered.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.arrays import let
from folioscope.llm.common import Work, keep_members, mark_members, skew_join

#: Words that are units when they follow a number. Fixed values.
UNITS = (
    "%|percent|kg|g|mg|lb|lbs|oz|km|m|cm|mm|miles|mile|inches|inch|feet|foot|ft|hours|hour|h|minutes|minute|min|"
    "seconds|second|s|days|day|weeks|week|months|month|years|year|dollars|dollar|euros|euro|usd|eur|litres|liters|l|ml"
)
_NO_ID = -(2**63)
_SLOT = "<(num|unit|name)>"


def single_spaced(text: Column) -> Column:
    """Runs of white space as one space each, so that what stands before a token doesn't depend on them."""
    return F.regexp_replace(text, "[\\x09-\\x0D][\\x20\\x09-\\x0D]*|\\x20[\\x20\\x09-\\x0D]+", " ")


_ENDS = "[.,;:!?\"')\\]*#$%&]"


def _bare(c: Column) -> Column:
    """Without the punctuation at the ends of tokens."""
    # Patterns begin with what must be there and look behind from it, as looking behind at every place is slow.
    return F.regexp_replace(c, f"{_ENDS}(?<=\\S{_ENDS}){_ENDS}*(?=\\s|$)", "")


def _template_of(spaced: Column) -> Column:
    c = F.regexp_replace(spaced, "\\p{Lu}(?<=[\\p{L}\\p{Nd},;:] \\p{Lu})[\\p{L}'-]*", "<name>")
    c = F.regexp_replace(c, "[0-9]+(?:[.,:/-][0-9]+)*", "<num>")
    c = F.lower(c)
    c = F.regexp_replace(c, f"<num>( ?)(?:{UNITS})(?![\\p{{L}}\\p{{Nd}}])", "<num>$1<unit>")
    return _bare(c)


def template(text: Column) -> Column:
    """The canonical form; it has as many white-space separated tokens as the text."""
    return _template_of(single_spaced(text))


def literal(text: Column) -> Column:
    """The text without case and punctuation at the ends of tokens, with values as they are; as many tokens as the template."""
    return _bare(F.lower(single_spaced(text)))


def tokens(spaced: Column) -> Column:
    return F.array_remove(F.split(spaced, " "), "")


def token_forms(text: Column) -> Column:
    """Struct of two arrays of equal length: c, the template's tokens, and l, the literal ones."""
    return let(single_spaced(text), lambda s: F.struct(tokens(_template_of(s)).alias("c"), tokens(_bare(F.lower(s))).alias("l")))


def window_hashes(ts: Column, w: int | Column) -> Column:
    """Hashes of all windows of w tokens; w from a column gives the same values, by slices, which are far slower."""
    return let(F.transform(ts, lambda x: F.xxhash64(x)), lambda hs: _hashes_at(hs, w, lambda h, i: h))


def _hashes_at(hs: Column, w: int | Column, form: Callable[[Column, Column], Column], kind: str = "array<bigint>") -> Column:
    """form(hash, place) of every window of w token hashes."""
    of = (lambda i: F.xxhash64(*[F.get(hs, i + k) for k in range(w)])) if isinstance(w, int) else (lambda i: F.xxhash64(F.slice(hs, i + 1, w)))
    return F.when(F.size(hs) < w, F.array().cast(kind)).otherwise(F.transform(F.sequence(F.lit(0), F.size(hs) - w), lambda i: form(of(i), i)))


def _all_windows(forms: Column, sizes: list[int]) -> Column:
    """(w, pos, hc, hl) of all windows of each of the sizes, from token arrays that are hashed once."""
    kind = "array<struct<w:int,pos:int,hc:bigint,hl:bigint>>"

    def of(x: Column) -> Column:
        def sized(w: int) -> Column:
            window = lambda hs, i: F.xxhash64(*[F.get(hs, i + k) for k in range(w)])
            both = lambda hc, i: F.struct(F.lit(w).alias("w"), i.alias("pos"), hc.alias("hc"), window(x["l"], i).alias("hl"))
            return _hashes_at(x["c"], w, both, kind)

        return F.concat(*[sized(w) for w in sizes])

    hashes = lambda f, side: F.transform(f[side], lambda t: F.xxhash64(t)).alias(side)
    return let(let(forms, lambda f: F.struct(hashes(f, "c"), hashes(f, "l"))), of)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns({"_dc_doc": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID)), "_dc_row": F.xxhash64(text)})


def _usable(ct: Column, w: Column) -> Column:
    """Whether a template window is evidence by itself: at least half of its tokens are literal."""
    return 2 * F.size(F.filter(ct, lambda x: ~x.rlike(_SLOT))) >= w


def benchmark_items(benchmark: DataFrame, window: int = 8, min_tokens: int = 5) -> DataFrame:
    """(item_id, item, w, ic, il): items long enough, with template tokens and literal tokens; item is the text's hash."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return (
        benchmark.where("item_id is not null")
        .select("item_id", F.xxhash64(text).alias("item"), token_forms(text).alias("f"))
        .select("item_id", "item", F.col("f.c").alias("ic"), F.col("f.l").alias("il"))
        .where((F.size("ic") >= min_tokens) & (F.size("ic") == F.size("il")))
        .withColumn("w", F.least(F.lit(window), F.size("ic")))
        .dropDuplicates(["item_id", "item"])
    )


def benchmark_windows(items: DataFrame) -> DataFrame:
    """(item_id, item, w, ipos, h): hashes of every window of every item, as literal tokens and, if usable, as template."""
    at = items.select(
        "item_id",
        "item",
        "w",
        F.explode(
            F.arrays_zip(
                F.sequence(F.lit(0), F.size("ic") - F.col("w")).alias("ipos"),
                window_hashes(F.col("ic"), F.col("w")).alias("hc"),
                window_hashes(F.col("il"), F.col("w")).alias("hl"),
            )
        ).alias("x"),
        "ic",
    ).select("item_id", "item", "w", "x.*", F.slice("ic", F.col("x.ipos") + 1, F.col("w")).alias("ct"))
    ways = F.when(_usable(F.col("ct"), F.col("w")), F.array_distinct(F.array("hc", "hl"))).otherwise(F.array("hl"))
    return at.select("item_id", "item", "w", "ipos", F.explode(ways).alias("h"))


def _windows(x: Column) -> Column:
    """Windows of an alignment whose tokens all agree, each as template or as it is.

    x: the item's tokens (ic, il), window w, and the document's tokens (dc, dl) from the item's token `start` on.
    """

    def window(i: Column) -> Column:
        cut = lambda ts, at: F.slice(ts, at + 1, x["w"])
        at = i - x["start"]
        both = F.arrays_zip(cut(x["ic"], i).alias("ic"), cut(x["il"], i).alias("il"), cut(x["dc"], at).alias("dc"), cut(x["dl"], at).alias("dl"))
        return let(
            both,
            lambda zs: F.struct(
                i.alias("ipos"),
                F.forall(zs, lambda z: z["il"] == z["dl"]).alias("exact"),
                F.forall(zs, lambda z: (z["ic"] == z["dc"]) | (z["il"] == z["dl"])).alias("agrees"),
                _usable(cut(x["ic"], i), x["w"]).alias("usable"),
                # As texts "value of the item, space, value of the document": tokens hold no spaces.
                F.transform(F.filter(zs, lambda z: z["ic"].rlike(_SLOT)), lambda z: F.concat_ws(" ", z["il"], z["dl"])).alias("slots"),
            ),
        )

    last = x["start"] + F.size(x["dc"]) - x["w"]
    places = F.when(last >= x["start"], F.sequence(x["start"], last)).otherwise(F.array().cast("array<int>"))
    return F.filter(F.transform(places, window), lambda v: v["agrees"])


def _evident(windows: Column) -> Column:
    """The windows that count: with few literal tokens, equal ones, and others only beside a usable one."""
    return let(F.exists(windows, lambda v: v["usable"]), lambda anchored: F.filter(windows, lambda v: v["exact"] | anchored))


def _consistent(windows: Column) -> Column:
    """Without the windows that hold a slot whose value stands for several; windows of equal tokens always stay."""
    sides = {"iv": 0, "dv": 1}

    def clashing(ps: Column) -> Column:
        """Pairs, all different, that share one value but not the other: values seen twice, found by sorting."""
        value = lambda p, side: F.get(F.split(p, " "), sides[side])

        def twice(side: str) -> Column:
            return let(F.sort_array(F.transform(ps, lambda p: value(p, side))), lambda s: F.filter(s, lambda v, i: (i > 0) & (v == F.get(s, i - 1))))

        seen = F.struct(*[twice(s).alias(s) for s in sides])
        return let(seen, lambda d: F.filter(ps, lambda p: F.array_contains(d["iv"], value(p, "iv")) | F.array_contains(d["dv"], value(p, "dv"))))

    pairs = F.array_distinct(F.flatten(F.transform(windows, lambda v: v["slots"])))
    kept = lambda bad: F.filter(windows, lambda v: v["exact"] | ~F.arrays_overlap(v["slots"], bad))
    return let(let(let(pairs, clashing), kept), _evident)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, window: int = 8, min_tokens: int = 5, coverage: float = 0.5, broadcast_windows: int = 250_000
) -> DataFrame:
    """(_dc_doc, _dc_row, item_id, item, covered, total): alignments of documents with items that reach the coverage."""
    work = Work(docs.sparkSession, "leaks")
    items = benchmark_items(benchmark, window, min_tokens).withColumn("len", F.size("ic"))
    bench = work.save(benchmark_windows(items), "windows")
    sizes = {r["w"]: r["n"] for r in bench.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `window` rows
    keyed = _keyed(docs.select("doc_id", "text"))
    text = F.coalesce(F.col("text"), F.lit(""))
    forms = token_forms(text)
    hashed = keyed.select("_dc_doc", "_dc_row", F.explode(_all_windows(forms, sorted(sizes) or [window])).alias("x"))
    ways = F.when(F.col("x.hc") == F.col("x.hl"), F.array("x.hc")).otherwise(F.array("x.hc", "x.hl"))
    found = hashed.select("_dc_doc", "_dc_row", "x.w", "x.pos", F.explode(ways).alias("h"))
    keys = bench.select("h").distinct()
    small = sum(sizes.values()) <= broadcast_windows
    hits = work.save(found.join(F.broadcast(keys), "h", "left_semi") if small else keep_members(found, "h", keys), "hits")
    # One passage may be in any number of documents, so hits meet the benchmark's windows in a salted join.
    weights = hits.groupBy("h", "w").agg(F.count(F.lit(1)).alias("n"))
    places = bench.select("h", "w", "item_id", "item", "ipos").join(weights, ["h", "w"])
    aligned = work.save(
        skew_join(hits, places, ["h", "w"], "n", "_dc_doc")
        .select("_dc_doc", "_dc_row", "item_id", "item", (F.col("pos") - F.col("ipos")).alias("offset"))
        .distinct(),  # the windows of an alignment give it once, and identical rows give the same
        "aligned",
    )
    uses = work.save(items.join(aligned.groupBy("item_id", "item").agg(F.count(F.lit(1)).alias("n")), ["item_id", "item"]), "uses")
    sized = skew_join(aligned, uses.select("item_id", "item", "len", "n"), ["item_id", "item"], "n", "_dc_doc")
    per_doc = sized.groupBy("_dc_doc", "_dc_row").agg(F.collect_list(F.struct("item_id", "item", "offset", "len")).alias("hits"))
    part = lambda ts, x: F.slice(ts, F.greatest(x["offset"], F.lit(0)) + 1, x["len"] + F.least(x["offset"], F.lit(0)))
    cuts = let(
        forms,
        lambda d: F.transform(
            "hits",
            lambda x: F.struct(
                x["item_id"].alias("item_id"),
                x["item"].alias("item"),
                F.greatest(-x["offset"], F.lit(0)).alias("start"),
                part(d["c"], x).alias("dc"),
                part(d["l"], x).alias("dl"),
            ),
        ),
    )
    sliced = keep_members(keyed, "_dc_doc", aligned).join(per_doc, ["_dc_doc", "_dc_row"]).select("_dc_doc", "_dc_row", F.explode(cuts).alias("x"))
    sliced = sliced.select("_dc_doc", "_dc_row", "x.*")
    met = skew_join(sliced, uses.select("item_id", "item", "w", "ic", "il", "n"), ["item_id", "item"], "n", "_dc_doc")
    names = ["ic", "il", "w", "start", "dc", "dl"]
    covered = met.select(
        "_dc_doc",
        "_dc_row",
        "item_id",
        "item",
        (F.size("ic") - F.col("w") + 1).alias("total"),
        F.explode(F.transform(let(F.struct(*names), lambda x: let(_windows(x), _consistent)), lambda v: v["ipos"])).alias("ipos"),
    )
    return (
        covered.groupBy("_dc_doc", "_dc_row", "item_id", "item")
        .agg(F.count_distinct("ipos").alias("covered"), F.max("total").cast("bigint").alias("total"))
        .where(F.col("covered") >= F.lit(coverage) * F.col("total"))
    )


def flag(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """docs with _dc_item (the item covered best, the smallest of equals, or null), _dc_covered and _dc_total."""
    best = Work(docs.sparkSession, "flags").save(
        find_leaks(docs, benchmark, **parameters)
        .groupBy("_dc_doc", "_dc_row")
        .agg(F.min(F.struct((-F.col("covered") / F.col("total")).alias("x"), "item_id", "covered", "total")).alias("b"))
        .select("_dc_doc", "_dc_row", F.col("b.item_id").alias("_dc_item"), F.col("b.covered").alias("_dc_covered"), F.col("b.total").alias("_dc_total")),
        "best",
    )
    marked = mark_members(_keyed(docs), "_dc_doc", best, "_dc_may")
    out = [*docs.columns, "_dc_item", "_dc_covered", "_dc_total"]
    # Only texts of flagged documents meet the flags; the others stay where they are.
    clean = marked.where("not _dc_may").withColumns({c: F.lit(None).cast(best.schema[c].dataType) for c in out[-3:]})
    return marked.where("_dc_may").join(best, ["_dc_doc", "_dc_row"], "left").select(*out).unionByName(clean.select(*out))


def op5_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = flag(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select(
        "doc_id",
        F.col("_dc_item").alias("item_id"),
        F.col("_dc_covered").alias("n_covered"),
        F.col("_dc_total").alias("n_windows"),
        F.col("_dc_item").isNotNull().alias("contaminated"),
    )
