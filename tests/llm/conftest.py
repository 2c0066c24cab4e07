import pytest

LONG = " ".join(f"w{i % 977}x" for i in range(30_000))
WORDS = " ".join(f"word{i}" for i in range(60))
EXTRA = ["row", "key", "node", "comp", "cell", "place", "epoch", "digest", "pos", "h1", "kept", "llr", "m_id", "id", "c0", "n"]


def edge_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    return [
        (1, WORDS, "en", "a", 5), (2, WORDS, "en", "a", 5), (3, WORDS.replace(" ", "  "), "en", "b", 5),
        (4, None, None, None, None), (5, "", "en", "a", 0), (6, "   \n\t ", None, "b", 6), (7, LONG, "de", "a", 9),
        (8, LONG + " tail", "de", None, 9), (9, "one", "fr", "b", 3), (10, "one two", "fr", "b", 7),
        (11, "One  TWO", "fr", "c", 7), (12, "été 中文 \U0001f600   x\x1cy", None, "c", 7),
        (1, WORDS, "en", "a", 5), (1, WORDS, "en", "a", 5), (1, "other text of the same id", "en", "a", 5),
        (None, "text without an id", "en", "a", 1), (None, "text without an id", "en", "a", 1), (None, None, None, None, None),
    ]


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_docs(docs):
    """The same rows with extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F
    return docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(EXTRA)])


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, None), (7, 1, None), (None, 1, 0), (9, None, None), (1, 1, 0)],
                                 "doc_id bigint, quality int, toxic int")


def pairs_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
