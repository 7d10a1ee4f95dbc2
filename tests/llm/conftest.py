import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, row string, key string, fp int, slot string, kept string"


def words(n, first=0):
    return " ".join(f"word{i}" for i in range(first, first + n))


TEXTS = [
    (1, words(80)),
    (2, words(80)),  # copy of 1
    (3, words(79) + " other"),
    (4, None),
    (5, ""),
    (6, " \t\n "),
    (7, "one"),
    (8, "One"),
    (9, words(60, 500) + "\n" + words(60, 700)),
    (None, words(80)),  # copy of 1 without an id
    (None, "no id here " + words(70, 2000)),
    (12, words(60, 900)),
    (12, words(60, 900)),  # repeated row
    (13, "é " * 70 + "ünïcode"),
    (14, words(30_000, 10_000)),  # very long
    (15, "x" * 200_000),  # one very long word
    (16, "a b c d " * 40),
]


@pytest.fixture(scope="session")
def messy(spark):
    """Null ids, texts and sources, empty and very long texts, copies, repeated rows, extra columns with clashing names."""
    sources = ["b", "a", None, "ä"]
    rows = [
        (i, t, None, sources[n % 4] if i != 12 else "a", None, n if i != 12 else 1, "r", None, 5, "s", None)
        for n, (i, t) in enumerate(TEXTS)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    """The documents of the smallest test folder."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
