"""The pipeline's stages on small documents, and the registered queries on the smallest tables."""

import duckdb
import pytest

import corpus_pipeline
from emberlog.llm import queries

SF_DIR = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        out = step(spark, docs, SF_DIR)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns and dict(out.dtypes) == dict(docs.dtypes), name
            assert 0 < out.count() <= n
            bad = out.filter("n_chars <> length(text) and n_chars is not null").count()
            assert bad == docs.filter("n_chars <> length(text) and n_chars is not null").count() == 0
        docs = corpus_pipeline.stage(out, "test")
    assert corpus_pipeline.run(spark, SF_DIR).count() == docs.count()


def test_sql_agrees(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_DIR}/embeddings.parquet'")
    for name, sql in queries.SQL.items():
        got = sorted(map(tuple, queries.run(name, spark, SF_DIR).collect()))
        assert got == sorted(con.execute(sql).fetchall())


@pytest.mark.parametrize("name", sorted(queries.PLANS))
def test_query_gives_rows(spark, name):
    assert queries.run(name, spark, SF_DIR).count() > 0
