import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def docs(spark):
    """Rows as a documents table with extra columns of clashing names."""
    def make(rows):
        schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                               T.StructField("lang", T.StringType()), T.StructField("rid", T.StringType()),
                               T.StructField("score", T.StringType()), T.StructField("n_chars", T.LongType())])
        full = [(d, t, lang, "x", "y", len(t or "")) for d, t, lang in (r if len(r) == 3 else (*r, None) for r in rows)]
        return spark.createDataFrame(full, schema)
    return make
