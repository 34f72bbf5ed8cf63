import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        # Names that operators use for themselves.
        T.StructField("ids", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("node", T.StringType()),
        T.StructField("length", T.IntegerType()),
    ]
)


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of ``(doc_id, text)`` rows, with columns of clashing names."""

    def build(rows):
        return spark.createDataFrame([(i, t, "x", None, "n", 3) for i, t in rows], DOCS)

    return build


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def real_texts(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}
