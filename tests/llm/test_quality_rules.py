import re
from collections import Counter

from folioscope.llm import quality_rules as q


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    cover = {j for i in range(len(w) - 4) if n[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover)


REPEATS = [(100, "a b c d e a b c d e"), (101, "x " * 30), (102, "a b c d e f a b c d e f a b c d"), (103, "l1\nl1\n \n \nl1"), (104, "a b c d e q b c d e r a b c d e"), (105, "a b c d")]


def test_features(spark, frame_of, messy_rows):
    rows = messy_rows + REPEATS
    got = sorted((repr(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in q.features(frame_of(rows)).collect())
    assert got == sorted((repr(i), *brute(t)) for i, t in rows)


def test_base_rule(spark, frame_of, messy_rows):
    rows = messy_rows + REPEATS
    for r in q.apply_rules(frame_of(rows), []).collect():
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed)


def row(bad, **values):
    return {f: 0.0 for f in q.FEATURES} | values | {"bad": bad}


def test_covering_finds_conjunctions():
    rows = [row(int(s > 5 and u > 5), symbols=float(s), upper=float(u)) for s in range(12) for u in range(12)] * 2
    rules = q.learn(rows)
    right = sum(r["bad"] == any(q._covers(rule, r) for rule in rules) for r in rows)
    assert right >= 0.95 * len(rows) and {c.feature for rule in rules for c in rule} == {"symbols", "upper"}
    assert q.learn([row(0)] * 30) == [] and q.learn([]) == []


def test_rules_are_one_ordered_expression(spark, frame_of):
    rules = [(q.Condition("n_words", False, 3.0),), (q.Condition("symbols", True, 0.5), q.Condition("n_words", True, 3.0))]
    df = frame_of([(1, "a b"), (2, "# # # # # # #"), (3, " ".join(map(str, range(20))))])
    assert {r.doc_id: (r.rule, r.kept) for r in q.apply_rules(df, rules).collect()} == {1: (1, False), 2: (2, False), 3: (0, True)}


def test_fit(spark, frame_of, words, nothing):
    good = [(i, words(30, i)) for i in range(60)]
    bad = [(i, " ".join(x + "###" for x in words(30, i).split())) for i in range(60, 120)]
    labels = spark.createDataFrame([(i, int(i < 60), None) for i in range(120)] + [(5, 1, None), (None, 0, None), (700, None, None)], "doc_id long, quality int, toxic int")
    rules = q.fit(frame_of(good + bad), labels)
    kept = {r.doc_id for r in q.apply_rules(frame_of(good + bad), rules).collect() if r.kept}
    assert kept == set(range(60))
    assert q.fit(nothing, labels.limit(0)) == [] and q.apply_rules(nothing, rules).count() == 0
