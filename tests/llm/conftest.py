import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators give to their own columns
        T.StructField("keep_id", T.StringType()),
        T.StructField("shard", T.StringType()),
        T.StructField("slot", T.StringType()),
        T.StructField("class_id", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("_text", T.StringType()),
        T.StructField("_digest", T.StringType()),
    ]
)
WORDS = "amber birch cedar delta ember fjord grove heath inlet jetty knoll ledge marsh north ocean plain quarry ridge shore tide".split()


def prose(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 31 + k * k + 7 * k * seed) % 20] + WORDS[(seed + 3 * k) % 20] for k in range(n))


def row(doc_id, text, lang="en"):
    return (doc_id, text, lang, "src", None if text is None else len(text), "x", "x", "x", "x", "x", "x", "x")


EDGE_ROWS = [
    row(9, None, None),
    row(4, None),
    row(3, ""),
    row(8, " \t\n "),
    row(5, "one  two\tthree"),
    row(2, "one two three"),
    row(2, "one two three"),  # a repeated row
    row(7, "one two three "),
    row(None, "one two three"),  # a null id among others
    row(None, "null id only"),
    row(11, prose(1, 40_000)),  # very long
    row(12, "12345 67890"),  # no letter
    row(13, "x" * 30_000),  # one long word
    row(14, "日本語 ☃ 😀 ▁ <|endoftext|>"),
    *[row(100 + k, "a hot text that many rows share") for k in range(30)],
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(EDGE_ROWS, DOCS).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def edge_rows():
    return EDGE_ROWS
