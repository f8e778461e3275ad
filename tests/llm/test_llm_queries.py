"""The queries of the training-data operators against their SQL twins, and the
pipeline, on the smallest tables."""

import corpus_pipeline
import pytest
from check import connect, duck_rows, spark_rows
from doctag.llm.queries import QUERIES
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_twin(spark, name):
    got = spark_rows(QUERIES[name].run(spark, SMALL))
    assert got == duck_rows(connect(SMALL), QUERIES[name].sql)


def test_entry_has_all_queries():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(n in names for n in QUERIES)
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


def test_pipeline_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SMALL).cache()
        assert docs.dtypes == before.dtypes
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= ids
        ids = now
    assert docs.filter("n_chars <> length(text)").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == ids


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.count() == 0


def test_pipeline_with_nulls_repeats_and_clashing_columns(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").limit(40)
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (7, "x " * 60_000, "en", "s", 9)],
        rows.schema,
    )
    docs = rows.unionByName(odd).withColumns({c: F.lit(5) for c in ("score", "line", "_row", "ref", "size", "key")})
    for name, stage in corpus_pipeline.STAGES:
        columns, docs = docs.columns, stage(spark, docs, SMALL)
        assert docs.count() > 0, name
        if name != "packing":
            assert docs.columns == columns
