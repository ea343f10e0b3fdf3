import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)

PROSE = (
    "The river ran past the old mill and the children of the village came down every evening to watch "
    "the water turn the wheel while their parents talked about the harvest and the price of grain. "
)


def number_words(start, count):
    """Text of words that no other text has."""
    letters = str.maketrans("0123456789", "abcdefghij")
    return " ".join(f"w{i}x".translate(letters) for i in range(start, start + count))


def edge_rows():
    """Nulls in any column, empty, blank and very long texts, repeated rows."""
    long_text = number_words(0, 20_000)
    return [
        (1, PROSE * 3, "en", "a", 1), (1, PROSE * 3, "en", "a", 1), (2, PROSE * 3 + "End.", "en", None, None),
        (3, None, None, None, None), (None, "Words without an id stand here.", "en", "b", 5), (4, "", "en", "b", 0),
        (5, " \t\n ", None, "b", 3), (6, long_text, "en", "a", len(long_text)), (7, "ß\u0000é漢字🙂 !!", "de", "c", 7),
        (8, "one two three", "en", "c", 13), (9, PROSE[::-1], "xx", "c", None),
    ]


@pytest.fixture
def edges(spark):
    """The edge rows with columns whose names the operators might use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(edge_rows(), DOCUMENTS)
    return df.withColumns({n: F.lit("own") for n in ("size", "key", "bucket", "hash", "score", "words", "n_words", "part")})


@pytest.fixture
def none(edges):
    return edges.limit(0)
