import re

from folioscope.llm import decontaminate as dc

BENCH = [
    (1, "Mary sold 48 apples to her friend Bob in April and then half as many in May, how many in all?"),
    (2, "what is the capital of the large country that lies south of the river near Basel"),
    (3, "too short"),
    (4, None),
    (5, "the five small words here"),
]


def bench(spark):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in BENCH], "item_id long, text string, h string, pos int")


def found(df, spark, **parameters):
    return {r.doc_id: r._dc_item for r in dc.flag(df, bench(spark), **parameters).collect()}


def test_copies_and_changed_parameters(spark, frame_of, words):
    filler = words(40, 1)
    rows = [
        (1, f"{filler} {BENCH[0][1]} {filler}"),
        (2, f"{filler} Mary sold 61 apples to her friend Tom in June and then half as many in July, how many in all? {filler}"),
        (3, f"{filler} Mary sold 61 apples to her friend Tom in June and then half as many in June, how many in all? {filler}"),
        (4, BENCH[1][1].upper()),
        (5, filler),
        (6, "Mary sold 48 apples"),
        (7, "well the five small words here are"),
        (8, BENCH[1][1].replace(" ", "\n\t")),
        (9, "too short"),
    ]
    got = found(frame_of(rows), spark)
    assert got[1] == 1 and got[2] == 1
    # one value of the item for two of the document is not a re-parameterised copy
    assert got[3] is None
    assert (got[4], got[5], got[6], got[7], got[8], got[9]) == (2, None, None, 5, 2, None)


def test_against_brute_force_on_literal_text(spark, frame_of, words):
    rows = [(i, words(30, i) if i % 3 else f"{words(10, i)} {BENCH[1][1]} {words(10, i + 500)}") for i in range(60)]
    norm = lambda t: re.sub(r"\s+", " ", t.lower())
    want = {i: 2 if norm(BENCH[1][1]) in norm(t) else None for i, t in rows}
    assert found(frame_of(rows), spark) == want
    assert found(frame_of(rows), spark, broadcast_windows=0) == want  # the shuffling join finds the same


def test_messy_and_empty(spark, messy, messy_rows, nothing):
    out = dc.flag(messy, bench(spark))
    assert out.count() == len(messy_rows) and set(messy.columns) < set(out.columns)
    assert out.where("_dc_item is not null").count() == 0
    assert dc.flag(nothing, bench(spark)).count() == 0
    assert dc.flag(messy, bench(spark).limit(0)).where("_dc_item is null").count() == len(messy_rows)


def test_a_passage_in_many_documents(spark, frame_of):
    rows = [(i, f"start {i} {BENCH[1][1]} end {i}") for i in range(500)]
    assert set(found(frame_of(rows), spark).values()) == {2}


def test_templates_keep_token_counts(spark, frame_of, messy_rows):
    from pyspark.sql import functions as F

    df = frame_of(messy_rows).where("text is not null")
    words = F.array_remove(F.split("text", "[\\x20\\x09-\\x0D]+"), "")
    bad = df.where((F.size(dc.token_forms(F.col("text"))["c"]) != F.size(words)) | (F.size(dc.token_forms(F.col("text"))["l"]) != F.size(words)))
    assert bad.count() == 0


def forms_by_hand(text):
    """Templates and literal tokens of a text, token by token."""
    import regex

    units = dc.UNITS.split("|")
    ends = ".,;:!?\"')]*#$%&"
    ws = [w for w in regex.split(r"[\x20\x09-\x0D]+", text) if w]
    c, before = [], ""
    for w in ws:
        x = w
        if before and regex.fullmatch(r"[\p{L}\p{Nd},;:]", before[-1]) and (m := regex.match(r"\p{Lu}[\p{L}'-]*", x)):
            x = "<name>" + x[m.end() :]
        x = regex.sub(r"[0-9]+(?:[.,:/-][0-9]+)*", "<num>", x).lower()
        x = regex.sub(rf"(?<=<num>)(?:{'|'.join(units)})(?![\p{{L}}\p{{Nd}}])", "<unit>", x)
        if c and c[-1].endswith("<num>") and (m := regex.match(rf"(?:{'|'.join(units)})(?![\p{{L}}\p{{Nd}}])", x)):
            x = "<unit>" + x[m.end() :]
        c.append(x)
        before = w
    bare = lambda x: x[0] + x[1:].rstrip(ends) if x[0] in ends and not x.strip(ends) else x.rstrip(ends) or x[0]
    return [bare(x) for x in c], [bare(w.lower()) for w in ws]


def leaks_by_hand(texts, items, window=8, min_tokens=5):
    """Covered windows of each item by each text, by comparing every window with every window."""
    out = {}
    slot = re.compile("<(num|unit|name)>")
    for ti, text in enumerate(texts):
        dc_, dl = forms_by_hand(text)
        for ii, item in items:
            ic, il = forms_by_hand(item)
            if len(ic) < min_tokens:
                continue
            w = min(window, len(ic))
            usable = [2 * sum(not slot.search(x) for x in ic[a : a + w]) >= w for a in range(len(ic) - w + 1)]
            offsets = {
                b - a
                for a in range(len(ic) - w + 1)
                for b in range(len(dl) - w + 1)
                if il[a : a + w] == dl[b : b + w] or usable[a] and (ic[a : a + w] in (dc_[b : b + w], dl[b : b + w])) or il[a : a + w] == dc_[b : b + w]
            }
            covered = set()
            for off in offsets:
                wins = []
                for a in range(len(ic) - w + 1):
                    b = a + off
                    if b < 0 or b + w > len(dl):
                        continue
                    if all(ic[a + k] == dc_[b + k] or il[a + k] == dl[b + k] for k in range(w)):
                        slots = {(il[a + k], dl[b + k]) for k in range(w) if slot.search(ic[a + k])}
                        wins.append((a, il[a : a + w] == dl[b : b + w], slots))
                pairs = set().union(*(s for _, _, s in wins)) if wins else set()
                bad = {p for p in pairs if any((p[0] == q[0]) != (p[1] == q[1]) for q in pairs)}
                wins = [x for x in wins if x[1] or not x[2] & bad]
                anchored = any(usable[a] for a, _, _ in wins)
                covered |= {a for a, exact, _ in wins if exact or anchored}
            if covered:
                out[ti, ii] = (len(covered), len(ic) - w + 1)
    return out


def problem(rnd):
    """A sentence of words, numbers, units and names in a random mixture, with names and numbers that repeat."""
    share, names, numbers = rnd.choice([0.1, 0.3, 0.6, 0.9]), rnd.sample(NAMES_LIST, 3), [str(rnd.randrange(2, 99)) for _ in range(4)]
    out = []
    for _ in range(rnd.randrange(5, 30)):
        if rnd.random() < share:
            out += rnd.choice([[rnd.choice(names)], [rnd.choice(numbers)], [rnd.choice(numbers), rnd.choice(["kg", "m", "hours"])]])
        else:
            out.append(rnd.choice(PLAIN) + rnd.choice(["", "", "", ","]))
    return " ".join(out)


def changed(text, rnd):
    """The same with other names and numbers, one for one."""
    numbers = [str(x) for x in rnd.sample(range(100, 999), 400)]
    names = dict(zip(NAMES_LIST, rnd.sample(["Zora", "Yann", "Xenia", "Wim", "Vera", "Uli"], 6), strict=True))
    table = {}
    return re.sub(r"[0-9]+", lambda m: table.setdefault(m[0], numbers[len(table)]), re.sub("|".join(NAMES_LIST), lambda m: names[m[0]], text))


NAMES_LIST = ["Anna", "Bob", "Carla", "Dirk", "Emma", "Finn"]
PLAIN = "how many apples does the farmer sell when it rains and what remains after lunch of these for each child".split()


def test_every_item_is_found_verbatim_and_with_other_values(spark, frame_of, words):
    """Random items: every copy counts all its windows; a re-parameterised one is found if any window has enough literal tokens.

    Items that begin with a name are left out of the latter, and no sentence ends within an item: a name is one only in mid-sentence.
    """
    import random

    rnd = random.Random(11)
    items = [(i, problem(rnd)) for i in range(40)]
    texts = [f"{words(9, i)} {t} {words(9, i + 500)}" for i, t in items] + [f"{words(9, i)} {changed(t, rnd)} {words(9, i + 500)}" for i, t in items]
    got = covered(frame_of(list(enumerate(texts))), spark, items)
    by_hand = leaks_by_hand(texts, items)
    assert got == by_hand
    at_half = {r.doc_id: r["_dc_item"] for r in dc.flag(frame_of(list(enumerate(texts))), spark.createDataFrame(items, "item_id long, text string")).collect()}
    long_enough = [i for i, t in items if len(t.split()) >= 5]
    assert all(got[i, i][0] == got[i, i][1] and at_half[i] is not None for i in long_enough)
    slot = re.compile("<(num|unit|name)>")
    for i in (i for i in long_enough if items[i][1].split()[0] not in NAMES_LIST):
        c, w = forms_by_hand(items[i][1])[0], min(8, len(items[i][1].split()))
        if any(2 * sum(not slot.search(x) for x in c[a : a + w]) >= w for a in range(len(c) - w + 1)):
            assert at_half[40 + i] is not None


def test_the_query(spark, sf_dir):
    """All columns of the query against plain Python, on the documents that share a rare word with an item and some others."""
    from folioscope.llm import queries

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect() if r.text]
    got = {r.doc_id: r for r in queries.QUERIES["op5_decontaminate"](spark, sf_dir).collect()}
    assert set(got) == set(docs)
    ids = [i for i, t in docs.items() if len(t) < 6000]
    tokens = {i: set(forms_by_hand(docs[i])[1]) for i in ids}
    item_tokens = {i: set(forms_by_hand(t)[1]) for i, t in items}
    want = {}
    for i in ids:
        near = [(k, t) for k, t in items if len(tokens[i] & item_tokens[k]) * 3 >= len(item_tokens[k])]
        found = {k: v for (_, k), v in leaks_by_hand([docs[i]], near).items() if 2 * v[0] >= v[1]}
        best = min(found, key=lambda k: (-found[k][0] / found[k][1], k), default=None)
        want[i] = (best, *(found[best] if found else (None, None)), bool(found))
    assert {i: (got[i].item_id, got[i].n_covered, got[i].n_windows, got[i].contaminated) for i in ids} == want


def covered(df, spark, items):
    """Windows of each item that each document covers, whatever the coverage."""
    items = spark.createDataFrame(items, "item_id long, text string")
    return {(r["_dc_doc"], r["item_id"]): (r["covered"], r["total"]) for r in dc.find_leaks(df, items, coverage=0.0).collect()}


def test_copies_in_other_spacing_and_case(spark, frame_of, words):
    item, filler = BENCH[0][1], words(20, 3)
    wrapped = re.sub("(.{30}\\S*) ", r"\1\n", item)
    other = "Mary sold 61 apples to her friend Tom in June and then half as many in July, how many in all?"
    texts = [item, item.replace(" ", "\n"), item.replace(" ", "  "), item.upper(), item.lower(), item.title(), wrapped]
    rows = [(i, f"{filler} {t} {filler}") for i, t in enumerate(texts)] + [(90, other.replace(" ", " \n")), (91, other.replace("half", "HALF"))]
    got = covered(frame_of(rows), spark, [(1, item)])
    assert got == {(i, 1): (14, 14) for i in [*range(len(texts)), 90, 91]}


DENSE = "Alice paid 5 kg, 7 kg and 9 kg; Bob paid 4 kg, 8 kg, 3 kg and 2 kg"
NAMES = "In 1990 Anna Maria Schmidt, Karl Otto Meyer and Eva Lena Huber, Jan Piet Bakker met Olga Weber"
MIXED = "the farmer told all of his friends that Alice paid 5 kg, 7 kg and 9 kg; Bob 4 kg, 8 kg, 3 kg and 2 kg"


def test_items_dense_in_values(spark, frame_of, words):
    filler = words(20, 3)
    mixed = MIXED.translate(str.maketrans("5794832", "1683274")).replace("Alice", "Carol").replace("Bob", "Dave")
    texts = [DENSE, NAMES.upper(), DENSE.translate(str.maketrans("579", "168")), MIXED, mixed, "12 kg 5 kg 3 kg 4 kg 8 kg 9 kg 1 kg"]
    df = frame_of([(i, f"{filler} {t} {filler}") for i, t in enumerate(texts)])
    items = [(1, DENSE), (2, NAMES), (3, MIXED)]
    got = covered(df, spark, items)
    full = lambda t: (len(t.split()) - 7,) * 2
    assert got[0, 1] == full(DENSE) and got[1, 2] == full(NAMES) and got[3, 3] == full(MIXED) and got[4, 3] == full(MIXED)
    # no window of item 1 has enough literal tokens for other values to be evidence
    at_half = {r.doc_id: r._dc_item for r in dc.flag(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert [at_half[i] for i in range(6)] == [1, 2, None, 3, 3, None]


def test_a_clash_removes_only_the_windows_that_hold_it(spark, frame_of, words):
    item = (
        "in the spring of 1990 the old farmer near the river sold all of his cattle to Bob because the price "
        "of grain in 1990 had risen above what he and his neighbour Tom could pay for it"
    )
    filler = words(20, 3)
    other = item.replace("1990", "1985").replace("Bob", "Joe").replace("Tom", "Sam")
    texts = [item, item.replace("in 1990", "in 1991"), item.replace("Bob", "Tom"), other, other.replace("in 1985", "in 1986")]
    got = covered(frame_of([(i, f"{filler} {t} {filler}") for i, t in enumerate(texts)]), spark, [(1, item)])
    ws = item.split()

    def without(*changed):
        return sum(not any(a <= c < a + 8 for c in changed) for a in range(len(ws) - 7))

    first, second, bob = ws.index("1990"), len(ws) - 1 - ws[::-1].index("1990"), ws.index("Bob")
    n = len(ws) - 7
    assert got == {(0, 1): (n, n), (1, 1): (without(second), n), (2, 1): (without(bob), n), (3, 1): (n, n), (4, 1): (without(first, second), n)}
