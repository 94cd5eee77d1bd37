"""MinHash near-dedup with bottom-k sketches (operator 2).

Documents are linked when the Jaccard similarity of their sets of distinct
5-word shingles is at least `percent` / 100. Exactly:

1. Every text becomes its set of 64-bit shingle hashes (one hash function), of
   which the `k` smallest are the sketch. Documents with equal sets form a class
   at once; only its representative (the smallest doc_id) goes on, so exact copies
   cost nothing, however many there are.
2. Inverted lists of retained values. Of the k smallest values of two sets' union,
   X are in both; all of these are retained by both sketches. For a linked pair X
   is hypergeometric around percent / 100 * k, so with k = 64 and t = 36 a
   pair of similarity 0.85 has X < t with probability below 1e-8. That is the only way to
   miss a pair: sets whose union has up to k shingles are never missed, and with
   exact=True sketches are whole sets and nothing is. A pair with X >= t shares at least t retained
   values, so by the prefix principle one among the |sketch| - t + 1 values rarest in the
   corpus, and only those are indexed; a value that half the corpus retains is
   reached only by documents that consist of such values.
3. All documents of a list go to the list's hub, its most connected document. A
   pair that shares a list shares its hub, so comparing within hub groups loses
   nothing, and a document is in as many groups as it has hubs, not lists.
4. Within a group, inverted lists are walked in rising order of value; each posting holds its
   rank in its sketch, so for every pair on a list it is known whether the value is
   among the k smallest of their union, and X counts up. Pairs on no common list
   are never looked at. X >= t (or, where the union has fewer than k values, X itself) is
   the union sketch's estimate; what passes is verified on the full sets, and only
   a spanning forest of verified links comes out, never all pairs.
   A group of more than `block` documents is first compared with its hub alone, in blocks.
   Documents linked with the hub needn't be compared with each other, as they
   are in one component already; the others, the rest, are dealt in blocks, one task unit per pair
   of a block of the rest with any block. So no task holds an unbounded group, and work grows
   with the group times its rest, not with the square of the group.
5. Components: smallest-label propagation with pointer jumping over the forests,
   each round written to the shared folder.

Defined cases: texts that are null, empty or blank have an empty set and are linked
with nothing; fewer than five words make one shingle; rows that share a doc_id
but not a text are compared each on its own, and classes with the same smallest
doc_id are one node; a null doc_id counts as the smallest id and comes out as
null; repeated rows are all returned; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.common import Work, keep_members, ship, skew_join, trimmed

SHINGLE = 5
_NO_ID = -(2**63)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xFF51AFD7ED558CCD)]


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def shingle_set(data: bytes) -> np.ndarray:
    """Sorted distinct hashes (int64) of the 5-word shingles of a UTF-8 text."""
    import xxhash

    words = data.lower().split()  # of bytes: A-Z only, and exactly the ASCII white space
    if not words:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(h) - SHINGLE + 1)
    out = np.full(n, len(h) if len(h) < SHINGLE else SHINGLE, np.uint64)
    for j in range(min(SHINGLE, len(h))):
        out = _mix(out * _ODD[j] + h[j : j + n])
    return np.unique(out.view(np.int64))


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for x in batch.column("text").cast(pa.binary()):
        yield x.as_py() or b""


def _sketched(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            sets = [shingle_set(t) for t in _texts(b)]
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            heads = [np.frombuffer(d, np.int64) for d in digests]
            kept = [s[:k] for s in sets]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in kept])]).astype(np.int32)
            flat = np.concatenate(kept) if kept else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc"),
                    pa.array(np.array([len(s) for s in sets], np.int64)),
                    pa.array(np.array([h[0] for h in heads], np.int64)),
                    pa.array(np.array([h[1] for h in heads], np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                ],
                names=["doc", "n", "s1", "s2", "sketch"],
            )

    return run


def _full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for b in batches:
        raw = [shingle_set(t).tobytes() for t in _texts(b)]
        s1 = np.array([np.frombuffer(xxhash.xxh3_128_digest(r), np.int64)[0] for r in raw], np.int64)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc"), b.column("of"), pa.array(s1), b.column("units"), pa.array(raw, pa.binary())], names=["doc", "of", "s1", "units", "shingles"]
        )


class _Forest:
    """Union-find over the documents of one unit."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def overlaps(a: list[np.ndarray], b: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Matrix of intersection sizes of two lists of sorted distinct arrays, by products of 0/1 matrices."""
    out = np.zeros((len(a), len(b)), np.float32)
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    both = np.intersect1d(flat_a, flat_b)  # other values add nothing
    row_a, row_b = np.repeat(np.arange(len(a)), [len(x) for x in a]), np.repeat(np.arange(len(b)), [len(x) for x in b])
    at_a, at_b = np.searchsorted(both, flat_a), np.searchsorted(both, flat_b)
    for flat, row, at, keep in ((flat_a, row_a, at_a, "a"), (flat_b, row_b, at_b, "b")):
        ok = (at < len(both)) & (both[np.minimum(at, len(both) - 1)] == flat) if len(both) else np.zeros(len(flat), bool)
        order = np.argsort(at[ok], kind="stable")
        if keep == "a":
            row_a, at_a = row[ok][order], at[ok][order]
        else:
            row_b, at_b = row[ok][order], at[ok][order]
    for c in range(0, len(both), columns):
        width = min(columns, len(both) - c)
        parts = []
        for row, at, n in ((row_a, at_a, len(a)), (row_b, at_b, len(b))):
            lo, hi = np.searchsorted(at, [c, c + width])
            m = np.zeros((n, width), np.float32)
            m[row[lo:hi], at[lo:hi] - c] = 1
            parts.append(m)
        out += parts[0] @ parts[1].T
    return out


def forest_of_links(
    sets: list[np.ndarray], side: np.ndarray, k: int, t: int, percent: int, crossing: bool
) -> list[tuple[int, int]]:
    """Verified links, as pairs of places, that span the components of a unit.

    crossing: only pairs between the two sides count, as pairs within a side are
    another unit's. Estimates come first; pairs that fail them are not verified.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    left = np.flatnonzero(side == 0) if crossing else np.arange(n)
    right = np.flatnonzero(side == 1) if crossing else np.arange(n)
    if not len(left) or not len(right):
        return []
    sl, sr = sizes[left][:, None], sizes[right][None, :]
    able = (100 * np.minimum(sl, sr) >= percent * np.maximum(sl, sr)) & (np.minimum(sl, sr) > 0)
    if not crossing:
        able &= np.tri(n, k=-1, dtype=bool)
    if not able.any():
        return []
    shared = shared_of_union([sets[i][:k] for i in left], [sets[i][:k] for i in right], k)
    # Sets within their sketches have a known union; any other union has k values or more.
    union = np.where(np.maximum(sl, sr) <= k, np.minimum(sl + sr - shared, k), k)
    able &= np.where(union < k, 100 * shared >= percent * union, shared >= t)
    rows, cols = np.flatnonzero(able.any(axis=1)), np.flatnonzero(able.any(axis=0))
    if not len(rows):
        return []
    inter = overlaps([sets[i] for i in left[rows]], [sets[i] for i in right[cols]]).astype(np.int64)
    total = sizes[left[rows]][:, None] + sizes[right[cols]][None, :] - inter
    linked = able[np.ix_(rows, cols)] & (100 * inter >= percent * total)
    forest, out = _Forest(n), []
    for a, b in zip(*np.nonzero(linked), strict=True):
        i, j = int(left[rows[a]]), int(right[cols[b]])
        if forest.join(i, j):
            out.append((i, j))
    return out


def shared_of_union(a: list[np.ndarray], b: list[np.ndarray], k: int) -> np.ndarray:
    """Matrix: of the k smallest values of two sorted arrays' union, how many are in both.

    Inverted lists, walked in rising order of value: where a value has rank i in
    one array and j in the other, i + j - (shared so far) values of the union come before it.
    """
    out = np.zeros((len(a), len(b)), np.int64)
    sizes = np.array([len(x) for x in a] + [len(x) for x in b])
    values = np.concatenate(a + b)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    rank = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    order = np.lexsort((owner, values))
    values, owner, rank = values[order], owner[order], rank[order]
    starts = np.flatnonzero(np.diff(values, prepend=values[0] - 1 if len(values) else 0))
    ends = np.append(starts[1:], len(values))
    long = (ends - starts > 1) & (owner[starts] < len(a)) & (owner[ends - 1] >= len(a)) if len(values) else np.zeros(0, bool)
    middles = starts + np.add.reduceat((owner < len(a)).astype(np.int64), starts) if len(values) else starts
    for s, m, e in zip(starts[long].tolist(), middles[long].tolist(), ends[long].tolist(), strict=True):
        at = np.ix_(owner[s:m], owner[m:e] - len(a))
        held = out[at]
        out[at] = held + (rank[s:m, None] + rank[None, m:e] - held < k)
    return out


def _unit_links(k: int, t: int, percent: int):
    """Rows (hub, bi, bj, side, doc, of, shingles), sorted by unit, to verified links; one unit is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, docs, texts, sets, sides = None, [], [], [], []

        def close() -> list[tuple[int, int, int]]:
            if len(docs) < 2:
                return []
            return [(docs[i], docs[j], texts[i]) for i, j in forest_of_links(sets, np.array(sides), k, t, percent, key[1] != key[2])]

        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("hub", "bi", "bj", "side", "doc", "of", "shingles")]
            out: list[tuple[int, int, int]] = []
            for hub, bi, bj, side, doc, of, raw in zip(*cols, strict=True):
                if (hub, bi, bj) != key:
                    out += close()
                    key, docs, texts, sets, sides = (hub, bi, bj), [], [], [], []
                elif docs and docs[-1] == doc and sides[-1] == side and sets[-1].tobytes() == raw:
                    continue  # a repeated row
                docs.append(doc)
                texts.append(of)
                sides.append(side)
                sets.append(np.frombuffer(raw, np.int64))
            if out:
                yield _links(out)
        if out := close():
            yield _links(out)

    return run


def _links(pairs: list[tuple[int, int, int]]) -> pa.RecordBatch:
    a = np.array(pairs, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(a[:, c]) for c in range(3)], names=["a", "b", "of"])


def connected_components(edges: DataFrame, work: Work) -> DataFrame:
    """(node, label): the smallest node reachable over edges (a, b). Rounds grow with the logarithm of path lengths."""
    both = work.save(
        edges.where("a <> b").select("a", "b").unionByName(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "both",
    )
    labels = work.save(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label"), F.count(F.lit(1)).alias("w")), "label0")
    step = 0
    while True:
        step += 1
        # Degrees are the weights: rows of a hub with very many neighbours are spread.
        near = (
            skew_join(both, labels.select(F.col("node").alias("b"), "label", "w"), ["b"], "w", "a").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        )
        best = labels.join(near, "node", "left").select("node", "w", "label", F.least("label", F.coalesce("near", "label")).alias("best"))
        best = work.save(best, f"best{step}")
        of = best.groupBy(F.col("best").alias("to")).agg(F.count(F.lit(1)).alias("cw"))
        roots = best.select(F.col("node").alias("to"), F.col("best").alias("jump")).join(of, "to")
        jumped = skew_join(best.withColumn("to", F.col("best")), roots.select("to", "jump", "cw"), ["to"], "cw", "node", "left")
        new = work.save(
            jumped.select("node", F.least("best", F.coalesce("jump", "best")).alias("label"), "w", F.col("label").alias("old")), f"label{step}"
        )
        labels = new.select("node", "label", "w")
        if new.where("label <> old").isEmpty():
            return labels.select("node", "label")
        work.drop(f"best{step}")
        if step > 1:
            work.drop(f"label{step - 1}")


def near_duplicates(
    docs: DataFrame, percent: int = 85, k: int = 64, t: int = 36, block: int = 128, block_shingles: int = 500_000, exact: bool = False
) -> DataFrame:
    """(doc, n, component), one row per row of docs; doc is doc_id with null as the least bigint.

    exact: sketches are whole sets, so no link is missed; all shingles are kept and counted, which costs accordingly.
    """
    if exact:
        k = t = 2**31 - 1
    ship(docs.sparkSession)
    work = Work(docs.sparkSession, "neardup")
    base = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID)).alias("doc"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    sketched = work.save(base.mapInArrow(trimmed(_sketched(k)), "doc long, n long, s1 long, s2 long, sketch array<long>"), "sketched")
    filled = sketched.where("n > 0")
    classes = work.save(filled.groupBy("s1", "s2").agg(F.min("doc").alias("rep"), F.count(F.lit(1)).alias("members")), "classes")
    reps = filled.join(classes.select("s1", "s2", F.col("rep").alias("doc")), ["s1", "s2", "doc"], "left_semi").dropDuplicates(["s1", "s2", "doc"])
    posts = reps.select("doc", "s1", "n", F.size("sketch").alias("kept"), F.explode("sketch").alias("v"))
    shared = work.save(posts.groupBy("v").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "shared")
    need = F.least(F.lit(t), F.ceil(F.col("kept") * (percent / 100)).cast("int"))
    # Values that nobody else holds are the rarest: they take the first places of the prefix and need no posting.
    places = F.size("vs") - need + 1
    indexed = work.save(
        skew_join(posts, shared, ["v"], "df", "doc")
        .groupBy("doc", "s1", "n", "kept")
        .agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("vs"))
        .where(places > 0)
        .select("doc", "s1", "n", F.size("vs").alias("common"), F.explode(F.slice("vs", F.lit(1), places)).alias("x"))
        .select("doc", "s1", "n", "common", F.col("x.v").alias("v")),
        "indexed",
    )
    hubs = work.save(
        indexed.groupBy("v")
        .agg(F.min(F.struct((-F.col("common")).alias("c"), "doc")).alias("h"), F.count(F.lit(1)).alias("df"))
        .where("df > 1")
        .select("v", F.col("h.doc").alias("hub"), "df"),
        "hubs",
    )
    members = work.save(skew_join(indexed, hubs, ["v"], "df", "doc").select("hub", "doc", "s1", "n").distinct(), "members")
    groups = work.save(
        members.groupBy("hub")
        .agg(F.count(F.lit(1)).alias("w"), F.sum("n").alias("load"))
        .where("w > 1")
        .withColumn("blocks", F.greatest(F.ceil(F.col("w") / F.lit(block)), F.ceil(F.col("load") / F.lit(block_shingles))).cast("int")),
        "groups",
    )
    unit = lambda bi, bj, side: F.struct(F.col("hub").alias("hub"), bi.cast("int").alias("bi"), bj.cast("int").alias("bj"), side.cast("int").alias("side"))
    up_to = lambda n: F.sequence(F.lit(0), n - 1)
    own = lambda n: F.pmod(F.xxhash64("doc", "s1"), n)

    def compared(dealt: DataFrame, name: str) -> DataFrame:
        """Links (a, b, of) found in the units of dealt(doc, s1, u); of: the text of a."""
        candidates = work.save(dealt.groupBy("doc", F.col("s1").alias("of")).agg(F.flatten(F.collect_list("u")).alias("units")), f"candidates_{name}")
        # Texts of candidates are read again and become full sets; the others stay out of the shuffle.
        full = keep_members(base, "doc", candidates).join(candidates, "doc").mapInArrow(
            trimmed(_full), "doc long, of long, s1 long, units array<struct<hub:long,bi:int,bj:int,side:int>>, shingles binary"
        )
        return work.save(
            full.where("of = s1")
            .select("doc", "of", "shingles", F.explode("units").alias("u"))
            .select("u.*", "doc", "of", "shingles")
            .repartition("hub", "bi", "bj")
            .sortWithinPartitions("hub", "bi", "bj", "side", "doc")
            .mapInArrow(trimmed(_unit_links(k, t, percent)), "a long, b long, of long"),
            f"links_{name}",
        )

    # A group of one block is one unit. In a larger one, every block meets the hub.
    of_hub = F.transform(up_to(F.col("blocks")), lambda o: unit(o, F.lit(-1), F.lit(1)))
    first = (
        F.when(F.col("blocks") == 1, F.array(unit(F.lit(0), F.lit(0), F.lit(0))))
        .when(F.col("doc") == F.col("hub"), of_hub)
        .otherwise(F.array(unit(own(F.col("blocks")), F.lit(-1), F.lit(0))))
    )
    links = compared(skew_join(members, groups.drop("load"), ["hub"], "w", "doc").select("doc", "s1", first.alias("u")), "hubs")
    large = groups.where("blocks > 1").select("hub", "w", "blocks")
    if not large.isEmpty():
        with_hub = links.select(F.col("a").alias("doc"), F.col("b").alias("hub"), F.col("of").alias("s1"), F.lit(True).alias("done")).distinct()
        in_large = skew_join(members.drop("n"), large, ["hub"], "w", "doc").where("blocks is not null")
        state = work.save(
            in_large.join(with_hub, ["hub", "doc", "s1"], "left").withColumn("rest", (F.col("doc") != F.col("hub")) & F.col("done").isNull()).drop("done"), "state"
        )
        # Blocks of the rest and of the others, as large as before.
        part = lambda n: F.ceil(F.col(n) * F.col("blocks") / F.col("w")).cast("int")
        rests = work.save(
            state.groupBy("hub", "w", "blocks").agg(F.count_if("rest").alias("r")).where("r > 0").withColumn("d", F.col("w") - F.col("r"))
            .select("hub", F.col("w").alias("weight"), part("r").alias("rb"), part("d").alias("db")),
            "rests",
        )
        placed = skew_join(state.select("hub", "doc", "s1", "rest"), rests, ["hub"], "weight", "doc").withColumn("own", own(F.when(F.col("rest"), F.col("rb")).otherwise(F.col("db"))))
        among = F.transform(up_to(F.col("rb")), lambda o: unit(F.least(o, F.col("own")), F.greatest(o, F.col("own")), F.col("own") > o))
        across = F.transform(up_to(F.col("db")), lambda o: unit(F.col("own"), F.col("rb") + o, F.lit(0)))
        others = F.transform(up_to(F.col("rb")), lambda o: unit(o, F.col("rb") + F.col("own"), F.lit(1)))
        second = placed.select("doc", "s1", F.when(F.col("rest"), F.concat(among, across)).otherwise(others).alias("u"))
        if not rests.isEmpty():
            links = links.unionByName(compared(second, "rest"))
    components = connected_components(links, work)
    of_class = work.save(
        classes.join(components, classes["rep"] == components["node"], "left").select("s1", "s2", "members", F.coalesce("label", "rep").alias("component")),
        "of_class",
    )
    rows = sketched.select("doc", "n", "s1", "s2")
    return (
        skew_join(rows.where("n > 0"), of_class, ["s1", "s2"], "members", "doc")
        .select("doc", "n", "component")
        .unionByName(rows.where("n = 0").select("doc", "n", F.col("doc").alias("component")))
    )


def keep_one(docs: DataFrame, **parameters) -> DataFrame:
    """docs without the near-duplicates of smaller ids; columns as given."""
    gone = near_duplicates(docs, **parameters).where("doc <> component").select(F.col("doc").alias("_nd_doc")).distinct()
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID))
    return docs.withColumn("_nd_doc", key).join(gone, "_nd_doc", "left_anti").select(*docs.columns)


def op2_near_dup(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    real = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    return found.select(
        real("doc").alias("doc_id"), F.col("n").alias("n_shingles"), real("component").alias("component_id"), (F.col("doc") == F.col("component")).alias("kept")
    )


#: Every pair that shares a shingle is counted and the links' closure taken: for small tables.
OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT p.a, p.b FROM pairs p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * p.c >= 85 * (x.n + y.n - p.c)
), steps AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(a, b) AS (SELECT a, b FROM steps UNION SELECT r.a, s.b FROM reach r JOIN steps s ON s.a = r.b
), least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(l.m, w.doc_id)) AS component_id, w.doc_id <= coalesce(l.m, w.doc_id) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN least l ON l.a = w.doc_id
"""
