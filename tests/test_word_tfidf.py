"""TF-IDF from stored words against the form that makes all n-grams."""

import random

import pytest
from doctag.operators import tfidf as X
from doctag.operators import word_tfidf as WT
from doctag.plans.catalog import features as T
from pyspark.sql import functions as F

PARTS = ["Sql", "dev", "fooBar", "กข", "คง", "กขคง", "a.", "b", "java", "food x", "foo bar", "ab", "cD", "b c d e", "\n", "", "ก", "คง ab"]


@pytest.fixture(scope="module")
def words(spark):
    rng = random.Random(1)
    text = lambda n: " ".join(rng.choices(PARTS, k=rng.randrange(n)))
    # Some keys are repeated or null, and texts have ends of sentences in all places.
    rows = [(i if i % 50 else None if i % 100 else 7, text(6), text(14)) for i in range(900)]
    rows += [(2000, None, None), (2001, "a", None), (2002, " . ", "zzz"), (2003, "", "")]
    words = T.words_once(spark.createDataFrame(rows, "doc_id long, title string, desc string"))
    marked = [(3000 + i, m, f"a|{m}|b|{m}|กข|ab|{m}|a") for i, m in enumerate(["\\\\", "\\\\|\\\\", "a|\\\\", "\\\\|a"] * 9)]
    return words.unionByName(spark.createDataFrame(marked, "doc_id long, title string, desc string"))


@pytest.mark.parametrize("limits", [(0.95, 0.005), (0.3, 0.02), (1.0, 0.1)])
def test_terms_and_weights_are_those_of_all_ngrams(spark, words, limits):
    assert WT.can_fit_words(words.count(), limits[1]) and not WT.can_fit_words(100, 0.005)
    seg = T._segments(words, arrays=True)
    want = X.fit_tfidf(seg, T.FIELDS, *limits)
    got = WT.fit_words(words, T.WORDS, *limits)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(got.terms) == rows(want.terms) != [] and (got.n_docs, got.limits) == (want.n_docs, want.limits)
    rounded = F.round("weight", 9).alias("weight")
    weights = rows(X.transform_tfidf(seg, want, "doc_id", T.FIELDS).select("doc_id", "field", "term", rounded))
    assert rows(WT.weights_of_words(words, got, "doc_id", T.WORDS).select("doc_id", "field", "term", rounded)) == weights != []
    known = WT.known_tokens(words, got, "doc_id", T.WORDS, T.FIELDS)
    assert rows(X.transform_tfidf(known, want, "doc_id", T.FIELDS).select("doc_id", "field", "term", rounded)) == weights


def test_rare_words_make_no_ngrams(spark, monkeypatch):
    rows = [(i, "a b", f"a b x{i} y{i} z{i} a b c") for i in range(500)]
    words = T.words_once(spark.createDataFrame(rows, "doc_id long, title string, desc string"))
    # The form that makes all n-grams is not used, and the terms are the frequent ones.
    monkeypatch.setattr(T, "fitted", lambda df: 1 / 0)
    terms = T.fitted_words(words).terms.filter("field = 'desc'")
    assert terms.count() == 0
    monkeypatch.setattr(T, "MAX_DF", 1.0)
    model = T.fitted_words(words)
    assert {r.term for r in model.terms.filter("field = 'desc'").collect()} == {"a", "b", "c", "a b", "b c", "a b c"}
    known = {r.doc_id: r.desc_seg for r in T.known_tokens(words, model).collect()}
    assert sorted(known[3]) == sorted(["a", "b", "a", "b", "c", "a b", "a b", "b c", "a b c"])
    plan = T.weights_of(words, model)._jdf.queryExecution().executedPlan().toString()
    assert "array<int>" in plan or "_tf" in plan


def test_empty_and_unknown(spark):
    none = spark.createDataFrame([], "doc_id long, title string, desc string")
    model = T.fitted_words(T.words_once(none))
    assert model.terms.count() == 0 and T.weights_of(T.words_once(none), model).count() == 0
    rows = T.words_once(spark.createDataFrame([(1, "a", "b")], "doc_id long, title string, desc string"))
    assert WT.weights_of_words(rows, model, "doc_id", T.WORDS).count() == 0
    assert [r.title_seg for r in WT.known_tokens(rows, model, "doc_id", T.WORDS, T.FIELDS).collect()] == [[WT.NO_TERM]]
