import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def make_docs(spark):
    """DataFrame of documents from (doc_id, text) or (doc_id, text, lang) rows."""

    def make(rows):
        full = [
            (r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1]))
            for r in rows
        ]
        return spark.createDataFrame(full, DOCUMENTS)

    return make
