import pytest

#: Columns of documents, and some whose names operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, pos int, line string, doc long, n long, h string, ids string, w string, part int, `end` int"


def frame(spark, rows):
    """documents of (doc_id, text), with languages and clashing extra columns."""
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), 1, "x", 9, 9, "h", "ids", "w", 0, 0) for i, t in rows], SCHEMA)


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def text_of(n, seed=0):
    import random

    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + str(rnd.randrange(60)) for _ in range(n))


#: Nulls, empty and blank texts, a long text, ties and repeated rows, a null id.
MESSY = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one"),
    (5, text_of(60)),
    (6, text_of(60)),
    (6, text_of(60)),
    (None, text_of(60)),
    (7, text_of(20_000, 3)),
    (8, "ünïcödé \U0001f600 \x00 tail\r\nline\n\n"),
    (9, "<>&#% ▁ ''\"\" \\ {}"),
]


@pytest.fixture(scope="session")
def messy(spark):
    return frame(spark, MESSY)


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [(1, "x")]).limit(0)


@pytest.fixture(scope="session")
def messy_rows():
    return MESSY


@pytest.fixture(scope="session")
def frame_of(spark):
    return lambda rows: frame(spark, rows)


@pytest.fixture(scope="session")
def words():
    return text_of
