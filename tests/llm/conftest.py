import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

PLAIN = (
    "The old harbour keeps its boats in the lee of a long stone wall while the ferry crosses twice a day and "
    "people wait with bags near the small office where tickets are sold by a man who knows every visitor by name "
    "and asks each of them how the weather was on the other side before he stamps the paper"
)

ODD = [
    (1, PLAIN, "en", "a", 1),
    (2, PLAIN, "en", "a", 1),
    (3, PLAIN.replace("ferry", "steamer"), "en", "b", 1),
    (4, None, None, None, None),
    (5, "", "en", "b", 0),
    (6, " \t\n\x0b\x0c\r ", "en", None, 7),
    (None, PLAIN + " again", "en", "c", 1),
    (None, "a lonely text without an id", None, "c", None),
    (7, "word " * 60_000, "en", "c", 300_000),
    (8, "x" * 200_000, "en", "c", 200_000),
    (9, "one word é😀 two", "fr", "é", 17),
    (10, "repeated row", "en", "a", 12),
    (10, "repeated row", "en", "a", 12),
    (11, "write to ann.b@mail.example.com or call +1 (171) 555-2028 from 10.0.0.255", "en", "a", 1),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd_docs):
    """Extra columns with names that the operators use themselves."""
    from pyspark.sql import functions as F

    names = ["score", "kept", "fingerprint", "component_id", "size", "rank", "row", "row_key", "base", "found"]
    names += ["piece", "label", "h", "word", "y", "bad", "n_words", "copies", "__words", "a.b"]
    return odd_docs.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
