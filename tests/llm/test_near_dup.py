import random
import re

import numpy as np

from folioscope.llm import near_dup as nd


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))) if ws else frozenset()


def brute(rows, percent=85):
    low = -(2**63)
    rows = [(low if i is None else i, shingles(t)) for i, t in rows]
    rep = {}
    for i, s in rows:
        rep[s] = min(i, rep.get(s, i))
    up = {i: i for i in rep.values()}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    sets = [s for s in rep if s]
    for k, a in enumerate(sets):
        for b in sets[:k]:
            inter = len(a & b)
            if 100 * inter >= percent * (len(a) + len(b) - inter):
                x, y = find(rep[a]), find(rep[b])
                up[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(rep[s]) if s else i) for i, s in rows)


def run(df, **parameters):
    return sorted((r.doc, r.n, r.component) for r in nd.near_duplicates(df, **parameters).collect())


def mutated(base, n, rnd):
    ws = base.split()
    for at in rnd.sample(range(len(ws)), n):
        ws[at] = f"new{rnd.randrange(10**9)}"
    return " ".join(ws)


def corpus(words, seed):
    rnd = random.Random(seed)
    rows, i = [], 0
    for b in range(12):
        base = words(rnd.choice([3, 5, 6, 12, 40, 70, 200]), seed * 100 + b)
        for _ in range(rnd.choice([1, 2, 9, 40])):
            text = mutated(base, rnd.randrange(0, max(1, len(base.split()) // 15) + 1), rnd)
            rows.append((i := i + 1, rnd.choice([text, text.upper(), base])))
    common = words(8, 999)
    rows += [(i + k + 1, common + " " + words(12, 5000 + k)) for k in range(60)]
    rnd.shuffle(rows)
    return rows


def test_against_brute_force(spark, frame_of, words):
    for seed in (1, 2):
        rows = corpus(words, seed)
        assert run(frame_of(rows)) == brute(rows)


def test_the_pipelines_threshold(spark, frame_of, words):
    rows = corpus(words, 3)
    assert run(frame_of(rows), percent=80, t=32) == brute(rows, 80)
    assert run(frame_of(rows), percent=80, exact=True) == brute(rows, 80)


def test_estimates_ask_for_no_more_than_t_shared_values():
    import inspect

    defaults = {n: p.default for n, p in inspect.signature(nd.near_duplicates).parameters.items()}
    k, t, percent = (defaults[n] for n in ("k", "t", "percent"))
    whole = np.arange(1000, dtype=np.int64)
    for shared in (t - 1, t, t + 2):
        # At exactly the threshold; one set holds the other, and `shared` of the whole's k smallest values are in both.
        part = np.concatenate([whole[:shared], whole[-(10 * percent - shared) :]])
        links = nd.forest_of_links([whole, part], np.array([0, 0]), k, t, percent, False)
        assert len(links) == (shared >= t)


def test_small_blocks_lose_nothing(spark, frame_of, words):
    rnd = random.Random(5)
    base = words(150, 77)
    rows = [(i, mutated(base, rnd.randrange(8), rnd)) for i in range(150)]
    assert run(frame_of(rows), block=16) == brute(rows)
    assert run(frame_of(rows), block_shingles=2000) == brute(rows)


def test_messy_and_empty(spark, messy, messy_rows, nothing):
    assert run(messy) == brute(messy_rows)
    assert run(nothing) == []
    kept = {r.doc_id for r in nd.keep_one(messy).collect()}
    assert kept == {1, 2, 3, 4, None, 7, 8, 9} and nd.keep_one(messy).columns == messy.columns


def test_large_group_of_exact_copies(spark, frame_of, words):
    rows = [(i, words(50, 1)) for i in range(800)] + [(1000, words(50, 2))]
    assert {c for _, _, c in run(frame_of(rows))} == {0, 1000}


def test_overlaps_equal_set_intersections():
    rng = np.random.default_rng(0)
    a = [np.unique(rng.integers(0, 50, rng.integers(0, 30))) for _ in range(9)]
    b = [np.unique(rng.integers(0, 50, rng.integers(0, 30))) for _ in range(7)]
    got = nd.overlaps(a, b, columns=8)
    assert (got == [[len(np.intersect1d(x, y)) for y in b] for x in a]).all()


def test_shared_values_of_the_unions_smallest():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(-60, 60, rng.integers(0, 70))) for _ in range(14)]
    for k in (1, 5, 16, 1000):
        got = nd.shared_of_union([s[:k] for s in sets[:6]], [s[:k] for s in sets[6:]], k)
        for i, a in enumerate(sets[:6]):
            for j, b in enumerate(sets[6:]):
                assert got[i, j] == len(set(np.union1d(a, b)[:k]) & set(a) & set(b))
    assert nd.shared_of_union([], [sets[0]], 4).shape == (0, 1)


def test_a_group_of_several_kinds_is_whole(spark, frame_of, words):
    """One common part, so that all meet in one hub group, and kinds that are linked within themselves only."""
    rnd = random.Random(8)
    common, rows = words(120, 4), []
    for kind in range(4):
        own = words(90, 50 + kind)
        rows += [(100 * kind + i, f"{common} {mutated(own, rnd.randrange(4), rnd)}") for i in range(30)]
    rnd.shuffle(rows)
    want = brute(rows)
    assert len({c for _, _, c in want}) >= 4
    for block in (8, 40, 1000):
        assert run(frame_of(rows), block=block) == want


def test_copies_near_the_hub_are_dealt_once(spark, frame_of, words, monkeypatch):
    """In a group in which all are linked with the hub, every set goes to one unit, whatever the number of blocks."""
    rows = [(i, words(200, 9) + f" tail{i}") for i in range(300)]
    sizes = {}
    keep = nd.Work.save

    def save(self, df, name):
        out = keep(self, df, name)
        if name.startswith("candidates"):
            sizes[name] = out.selectExpr("sum(size(units))").first()[0]
        return out

    monkeypatch.setattr(nd.Work, "save", save)
    assert run(frame_of(rows), block=16) == brute(rows)
    assert sum(sizes.values()) < 2 * len(rows)


def test_components(spark):
    from folioscope.llm.common import Work

    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, k) for k in range(501, 900)] + [(rnd.randrange(1000, 1060), rnd.randrange(1000, 1060)) for _ in range(40)]
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.label for r in nd.connected_components(df, Work(spark, "test")).collect()}
    assert got == {x: find(x) for e in edges for x in e if any(a != b and x in (a, b) for a, b in edges)}


def test_query_equals_sql(spark, sf_dir, duck):
    from llm_oracle import compare

    compare("op2_near_dup", spark, sf_dir, duck)
