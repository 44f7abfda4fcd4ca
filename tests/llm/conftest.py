import pytest
from pyspark.sql import types as T

WORDS = "the river rose for days before bridge gave way and town had to wait boats while rain fell on roofs fields roads".split()
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def prose(seed: int, words: int) -> str:
    """Words that repeat in no short window."""
    out, x = [], seed * 7919 + 13
    for k in range(words):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 16) % len(WORDS)] + ("" if k % 9 else str(x % 97)))
    return " ".join(out)


def edge_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows."""
    long = prose(99, 30_000)
    same = prose(5, 120)
    rows = [
        (1, None, "en", "a", None),
        (2, "", None, "a", 0),
        (3, " \n\t ", "en", None, 4),
        (4, "one", "en", "b", 3),
        (5, same, "en", "b", len(same)),
        (6, same, "de", "c", len(same)),
        (6, same, "de", "c", len(same)),
        (7, long, "en", "", len(long)),
        (None, prose(8, 80), "en", "a", 1),
        (8, "é 日本 ñ　x " * 20, None, None, None),
        (9, same.replace("river", "stream", 1), "en", "b", 1),
    ]
    return rows + [(k, prose(k, 60 + k), "en", "abc"[k % 3], 1) for k in range(20, 60)]


@pytest.fixture(scope="session")
def edge_docs(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(edge_rows(), DOCS).repartition(3).write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small_docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
