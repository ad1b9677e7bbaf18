import pytest
from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from texts (ids in order) or (id, text) pairs, with extra columns whose names operators use inside."""

    def build(texts, clash=True):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCUMENTS)
        if clash:
            for name in ("th", "row", "node", "length", "shard", "start", "piece", "ids", "score", "spans", "_d", "_t", "key"):
                df = df.withColumn(name, F.lit("x"))
        return df

    return build
