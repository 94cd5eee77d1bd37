import numpy as np
import pytest

from folioscope.llm import pieces as pc

TEXTS = ["", "Hello  world", " a", "a\nb\r\n\n", "é▁x ▁▁", "ﬁ １", "  ", "\t\ty", "a" * 500, "x².5 2².", "foo_bar __ 12 34  5", "हिन्दी में", "a-b--c http://x.y/z?q=1", "½ a½b٣٤", "𝔘x 漢字 \U0001f600 \x00"]


@pytest.fixture(scope="module")
def vocabulary():
    return pc.Vocabulary.load(pc.default_model())


def ids_of(packed):
    return np.frombuffer(packed, np.int32).tolist()


def test_without_dropout_ids_are_the_librarys(vocabulary, words):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pc.default_model())
    for t in [*TEXTS, words(300)]:
        if "▁" not in t and "\x00" not in t:
            assert vocabulary.encode(t) == sp.encode(t)


def encoded(v, texts, p, seed, ids=None, **options):
    ids = range(len(texts)) if ids is None else ids
    flat, sizes = v.encode_texts(texts, [pc.document_key(i, seed) for i in ids], p, **options)
    return [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])]


@pytest.mark.parametrize("p", [0.0, 0.1, 0.7, 1.0])
def test_batches_equal_single_texts_and_decode_exactly(vocabulary, words, p):
    texts = [*TEXTS, words(2000, 5), words(50, 6).replace(" ", "")]
    for options in ({}, {"step": 7}, {"remember": 3}):
        for i, (t, ids) in enumerate(zip(texts, encoded(vocabulary, texts, p, 7, **options), strict=True)):
            assert ids == vocabulary.encode(t, p, 7, i)
            assert vocabulary.decode(ids) == t


def test_scan_and_heap_agree(vocabulary):
    for key in range(40):
        part = " " + "thequickbrownfoxesjumping"[: 5 + key % 20]
        assert vocabulary.merge(part, 0.3, key * 7919) == vocabulary._merge_long(part, 0.3, key * 7919)


def test_dropout_varies_by_seed_document_and_occurrence_and_repeats(vocabulary, words):
    t = words(200, 9)
    one = vocabulary.encode(t, 0.2, 1, 0)
    assert one == vocabulary.encode(t, 0.2, 1, 0)
    assert one != vocabulary.encode(t, 0.2, 1, 1) and one != vocabulary.encode(t, 0.2, 2, 0)
    assert len(one) > len(vocabulary.encode(t))
    repeated = ["internationalisation " * 400] * 20
    cuts = [set() for _ in repeated]
    for own, ids in zip(cuts, encoded(vocabulary, repeated, 0.1, 1), strict=True):
        pieces = [vocabulary.table[k] for k in ids]
        word: list[bytes] = []
        for x in [*pieces, b" "]:
            if x.startswith(b" ") and word:
                own.add(tuple(word))
                word = []
            word.append(x)
    assert min(map(len, cuts)) > 10 and len(set().union(*cuts)) > 2 * max(map(len, cuts))


def test_candidates_are_skipped_at_the_rate_asked_for(vocabulary):
    """A part of one candidate stays in two pieces in a share p of its occurrences."""
    pair = next(x for x in (" a", "ab", "er", "in") if len(vocabulary.encode(x[1:] if x[0] == " " else x)) == 1)
    part = pair.strip()
    n = 40_000
    _, sizes = vocabulary.encode_parts([part] * n, pc.occurrence_keys(pc.document_key(1, 2), 0, n), 0.1)
    _, _, _, n_candidates = vocabulary.merge_all([" " + part])
    whole = len(vocabulary.encode(part))
    assert n_candidates[0] > 0 and abs((sizes != whole).mean() - (1 - 0.9 ** n_candidates[0])) < 0.02


def test_frames(spark, messy, messy_rows, nothing):
    got = pc.round_trip(messy, pc.default_model()).collect()
    assert len(got) == len(messy_rows) and all(r.lossless for r in got)
    assert {r.doc_id: r.n_pieces for r in got if r.doc_id in (1, 2)} == {1: 0, 2: 0}
    decoded = pc.decode(pc.encode(messy, pc.default_model()), pc.default_model())
    assert sorted(r.decoded for r in decoded.collect()) == sorted(t or "" for _, t in messy_rows)
    assert pc.round_trip(nothing, pc.default_model()).count() == 0
