import pytest

WIDE = "doc_id long, text string, lang string, source string, n_chars long, score double, start long, grp long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) rows, with more columns whose names clash with those of results."""

    def make(rows, partitions=3):
        wide = [(d, t, "en", None if d is None else f"s{d % 3}", None if t is None else len(t), 0.5, 7, None) for d, t in rows]
        return spark.createDataFrame(wide, WIDE).repartition(partitions)

    return make


@pytest.fixture
def scratch(tmp_path):
    return f"file://{tmp_path}"


ODD = [
    (1, ""),
    (2, None),
    (None, "a b c"),
    (3, " \n\t "),
    (4, "one two three"),
    (4, "one two three"),
    (5, "x" * 5000),
    (6, "é ü ñ 漢字 😀 " * 50),
    (7, "word " * 20000),
    (None, None),
]


@pytest.fixture(scope="session")
def odd(docs_of):
    return docs_of(ODD)


@pytest.fixture(scope="session")
def empty(docs_of):
    return docs_of([], 1)


@pytest.fixture(scope="session")
def odd_rows():
    return ODD
