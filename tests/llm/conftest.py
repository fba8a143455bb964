import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def scratch(spark):
    from mailweave.llm.common import Scratch

    def make(name="test"):
        return Scratch(spark, name)
    return make


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


#: texts that every text operator has to take
ODD_TEXTS = [None, "", " \t\n", "a", "word " * 40_000, "\x00\x1c\x85 \u00a0", "é中\U0001f600 İΣ", "x" * 100_000]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows, a null
    and a repeated id, and extra columns named like the operators' own."""
    rows = [(k, t, "en", "s", 1) for k, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id", None, None, None), (None, None, None, None, None), (3, "a", "en", "s", 1), (3, "b", None, "s", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    from pyspark.sql import functions as F
    for name in ("fp", "node", "key", "score", "lang_pred", "component_id", "kept_id", "ids", "a", "b", "block", "spans",
                 "item_id", "y", "x", "start"):
        df = df.withColumn(name, F.lit("clash"))
    return df
