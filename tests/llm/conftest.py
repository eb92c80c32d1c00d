import pytest
from pyspark.sql import types as T

from rewardloom.llm.common import ship

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty and blank texts, a very long text, repeated rows, ties, odd characters, and columns
    that operators use inside."""
    long = " ".join(f"word{i % 977} and then" for i in range(30_000))
    same = "The same line of some seven words.\nAnother line follows here, quite alike."
    rows = [(1, same, "en", "a", 10), (1, same, "en", "a", 10), (2, same, "en", "b", 10), (3, None, "en", "a", 0), (4, "", None, None, None),
            (5, " \t\n ", "fr", "c", 4), (6, long, "en", "a", len(long)), (None, "a text without an id, of a few words", "en", None, 3),
            (7, "12 34 !!! ###", "de", "b", 13), (8, "naïve\0text\x0bwith   odd spaces  and\r\n\r\nmore <|endoftext|>", "fr", "d", 30),
            (9, "Le chat est sur la table et la porte est fermée.", "fr", "d", 40), (10, "Der Hund und die Katze sind nicht da.", "de", "d", 40),
            (11, "The cat is on the table and the door is shut.", "en", "d", 40), (12, None, None, None, None)]
    names = "h size rank block shard at p score cls band x half third host path site bucket copies __salt __row_hash __row_id __row_portion __row_copies no rows".split()
    out = spark.createDataFrame(rows, DOCS)
    for i, n in enumerate(names):
        out = out.selectExpr("*", f"{i} AS `{n}`")
    return out.repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], T.StructType().add("doc_id", "long").add("quality", "integer").add("toxic", "integer"))
