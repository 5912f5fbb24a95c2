import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, extra columns with clashing names."""
    rows = [
        (None, None, None, None, None),
        (1, "", "en", "a", 0),
        (2, " \n\t ", None, None, 4),
        (3, "one two three four five six seven eight nine ten eleven", "en", "a", 55),
        (4, "one two  three four five six seven eight nine ten eleven", "en", "b", 56),
        (4, "one two  three four five six seven eight nine ten eleven", "en", "b", 56),
        (5, "Mail jane.doe@mail.example.com or +1 (706) 555-3138.\n" * 3, "de", "b", 1),
        (6, "x" * 30_000, "xx", "c", 30_000),
        (7, "word " * 6_000, "fr", "c", 30_000),
        (8, "é ü   \U0001f600 1.2.3.4 and 4111 1111 1111 1111", "fr", "d", 9),
        (9, "The cat sat on the mat. " * 9 + "A line of its own follows here.", "en", "a", 9),
        (None, "no id here but some text", "en", "a", 9),
    ]
    df = spark.createDataFrame(rows, DOCS)
    for name in ("id", "row", "size", "shard", "digest", "kept", "copies", "key", "place", "n"):
        df = df.selectExpr("*", f"'{name}' AS `{name}`")
    return df


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
