import pytest
from pyspark.sql import types as T

DOC = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, spread=4):
        """rows: (doc_id, text) or (doc_id, text, source)."""
        data = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0 if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(data, DOC)
        return df.repartition(spread) if rows else df
    return make


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
