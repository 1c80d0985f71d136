import pytest

from strataload.llm.common import prepare


@pytest.fixture(scope="session", autouse=True)
def prepared(spark):
    return prepare(spark)


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs in every column, empty, blank and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 977} of{i % 31}" for i in range(60_000))
    plain = "the quick brown fox jumps over the lazy dog and then it sleeps under a tree near the river"
    return [
        (1, plain, "en", "a", 1),
        (1, plain, "en", "a", 1),
        (2, plain, "en", None, None),
        (3, None, None, None, None),
        (4, "", "en", "a", 0),
        (5, " \t\n \x0b\x0c\r", None, "b", 5),
        (None, plain, "en", "b", 1),
        (None, None, None, None, None),
        (6, long, "en", "b", len(long)),
        (7, "one two", "en", "c", 7),
        (8, "ONE two", "en", "c", 7),
        (9_007_199_254_740_993, "?! 123 ...", "en", "c", 10),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows with extra columns whose names the operators use themselves."""
    df = spark.createDataFrame(odd_rows, DOCUMENTS)
    extra = ("row", "kept_id", "size", "at", "score", "copies", "label", "id", "m", "u", "n", "key")
    return df.selectExpr("*", *[f"'x{i}' as {name}" for i, name in enumerate(extra)])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
