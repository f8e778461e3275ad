"""Every catalog query against its SQL twin on the smallest tables."""

import pytest

from check import compare, connect
from conftest import SMALL
from doctag.plans.catalog import QUERIES

MEDIUM = "/root/testdata/sf0.01"
# Folds and shares of the labelled rows of the smallest tables can lack a class.
NEED_MORE_ROWS = {"cross_validation", "cross_validated_scores", "learning_curve"}


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_query(spark, con, name):
    more = name in NEED_MORE_ROWS
    ok, note = compare(spark, connect(MEDIUM) if more else con, MEDIUM if more else SMALL, QUERIES[name])
    assert ok, note


PREDICTORS = ("tree_classifier", "linear_svc_classifier", "linear_score_classifier", "side_by_side_predictions")


@pytest.mark.parametrize("name", PREDICTORS)
def test_predictors_judge_all_documents(spark, name):
    """No twin: every document gets one of the two classes, and most labelled ones
    their own."""
    out = QUERIES[name].run(spark, SMALL).cache()
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    assert sorted(ids) == [r.doc_id for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()]
    for column in (c for c in out.columns if c != "doc_id"):
        assert {r[0] for r in out.select(column).distinct().collect()} <= {"0", "!0"}


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_text_plans_have_no_python(spark):
    for name in ("all_ngrams", "document_frequency", "rule_tags", "clean_parity", "term_frequency"):
        plan = QUERIES[name].run(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan, name
