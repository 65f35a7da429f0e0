import pytest

from unitcast.llm import common

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "wordy " * 30_000


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    common.ship(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, extra clashing columns."""
    rows = [(1, "a line of text\nshort\na line of text", "en", "src0", 35), (2, None, None, None, None), (3, "", "en", "src0", 0),
            (4, LONG, "en", "src1", len(LONG)), (5, "A LINE of text \nother words here", "de", "src0", 30),
            (5, "A LINE of text \nother words here", "de", "src0", 30), (None, "a line of text", "en", None, 14),
            (6, "été à la plage \U0001f600\tdone", "fr", "src2", 20)]
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    return (df.selectExpr("*", "'x' AS n_lines", "7 AS shard", "'y' AS ids", "array(1) AS links", "'z' AS fingerprint",
                          "1.5D AS _dropped").repartition(3))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
