import math

import pytest
from pyspark.sql import functions as F

from doctag.operators import bayes as B
from doctag.operators import lemmas as L
from doctag.operators import metrics as M
from doctag.operators import tfidf as X
from doctag.operators import vocabulary as V
from doctag.plans import training as P

TRAIN = [
    (0, "sql dev", "java|sql|sql dev", "1"),
    (1, "dev", "java|java|team", "1"),
    (2, "cook", "food|team", "0"),
    (3, "", "food|kitchen|food", "0"),
]


@pytest.fixture(scope="module")
def train(spark):
    rows = [(i, t.replace(" ", "|"), d, tag) for i, t, d, tag in TRAIN]
    return spark.createDataFrame(rows, "id long, title_seg string, desc_seg string, tag string")


@pytest.fixture(scope="module")
def fitted(train):
    return X.fit_tfidf(train, P.FIELDS)


def test_idf(fitted):
    idf = {(r.field, r.term): r.idf for r in fitted.terms.collect()}
    assert idf[("desc", "java")] == pytest.approx(math.log(5 / 3) + 1)
    assert idf[("title", "")] == pytest.approx(math.log(5 / 2) + 1)
    assert len(idf) == 4 + 6


def test_prune(train):
    counts = X.field_document_frequency(train, {"desc": "desc_seg"})
    keep = lambda *a: {r.term for r in X.prune(counts, 4, *a).collect()}
    assert keep(1.0, 2) == {"java", "team", "food"}
    assert keep(0.25, 1) == {"sql", "sql dev", "kitchen"}
    with pytest.raises(ValueError):
        X.prune(counts, 4, 1, 2)


def test_vectors_agree_with_the_long_form(spark, train, fitted):
    stages = P.vectorizer(fitted)
    vec = {r.id: r.features.toArray() for r in P.vectorize(train, stages).collect()}
    index = {(r.field, r.term): r["index"] for r in P.term_index(spark, stages).collect()}
    assert sorted(index.values()) == list(range(10))
    assert max(v for (f, _), v in index.items() if f == "title") == 3
    seen = 0
    for r in X.transform_tfidf(train, fitted, "id", P.FIELDS).collect():
        assert vec[r.id][index[(r.field, r.term)]] == pytest.approx(r.weight)
        seen += 1
    assert seen == sum((v > 0).sum() for v in vec.values())


def test_long_bayes_agrees_with_the_vector_model(spark, train, fitted):
    weights = X.transform_tfidf(train, fitted, "id", P.FIELDS)
    long = B.fit_bayes(weights, train, fitted.terms, "id", ["0", "1"])
    stages = P.vectorizer(fitted)
    model = P.fit(P.vectorize(train, stages), "bayes")
    a = {(r["class"], r.field, r.term): r.logp for r in B.term_scores(long).collect()}
    b = {(r["class"], r.field, r.term): r.logp for r in P.term_log_probability(spark, model, stages).collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k]) for k in a)
    x = B.predict_bayes(weights, train.select("id"), long, "id").orderBy("id").collect()
    y = P.predict(model, P.vectorize(train, stages), scores=True).orderBy("id").collect()
    for p, q in zip(x, y):
        assert p.predict == q.predict and p.probability == pytest.approx(list(q.probability))
    assert B.top_terms(long, 1).count() == 2


def test_unknown_document_gets_the_prior(spark, train, fitted):
    weights = X.transform_tfidf(train, fitted, "id", P.FIELDS)
    long = B.fit_bayes(weights, train.filter("id > 0"), fitted.terms, "id", ["0", "1"])
    new = spark.createDataFrame([(9,)], "id long")
    row = B.predict_bayes(weights.filter("id = 9"), new, long, "id").first()
    assert row.predict == "0" and row.probability == pytest.approx([2 / 3, 1 / 3])


@pytest.mark.parametrize("kind,params", [("bayes", {}), ("tree", {}), ("svc", {"maxIter": 5}), ("linear", {"regParam": 0.01})])
def test_classifiers_learn_the_training_rows(train, fitted, kind, params):
    data = P.vectorize(train, P.vectorizer(fitted))
    out = P.predict(P.fit(data, kind, **params), data, "said")
    assert all(r.tag == r.said for r in out.collect())
    assert out.columns == [*data.columns, "said"]


def test_thresholds_and_cutoff(train, fitted):
    data = P.vectorize(train, P.vectorizer(fitted))
    never = P.predict(P.fit_thresholds(data, {"0": 0.0001, "1": 0.9999}), data)
    assert {r.predict for r in never.collect()} == {"0"}
    scored = P.predict(P.fit(data, "bayes"), data, scores=True)
    p1 = F.get("probability", F.lit(1))
    assert {r.predict for r in P.cutoff(scored, p1, 0.999).collect()} == {"0"}
    with pytest.raises(ValueError):
        P.fit(data, "other")


def test_save_and_load(train, fitted, tmp_path):
    stages = P.vectorizer(fitted)
    model = P.fit(P.vectorize(train, stages), "bayes")
    P.save_model(stages, str(tmp_path / "v"))
    P.save_model(model, str(tmp_path / "m"))
    again = P.predict(P.load_model(str(tmp_path / "m")), P.vectorize(train, P.load_model(str(tmp_path / "v"))))
    assert {r.id: r.predict for r in again.collect()} == {0: "1", 1: "1", 2: "0", 3: "0"}


def test_cross_validation_and_curve(spark, train, fitted):
    data = P.vectorize(train, P.vectorizer(fitted))
    many = data.crossJoin(spark.range(6).withColumnRenamed("id", "r")).withColumn("id", F.col("id") * 10 + F.col("r"))
    scores = P.cross_val_f1(many, "bayes", "id", 3).collect()
    assert [r.fold for r in scores] == [0, 1, 2] and all(r.macro_f1 == 1.0 for r in scores)
    best, table = P.cross_validate(many, "bayes", "id", {"smoothing": [0.5, 1.0]}, 3)
    assert table.count() == 2 and best is not None
    curve = P.learning_curve(many, "bayes", "id", sizes=(0.5, 1.0), splits=2).collect()
    assert len(curve) == 4 and all(0 <= r.valid_score <= 1 for r in curve)
    parts = {(r.sample, r.label): r.support for r in P.evaluate_split(many, "bayes", "id", 0.25).collect()}
    assert parts[("in_sample", "avg / total")] == 24 and parts[("hold_out", "avg / total")] == 6


def test_report(spark):
    rows = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "a")]
    df = spark.createDataFrame(rows, "tag string, predict string")
    got = {r.label: r for r in M.report(df).collect()}
    assert (got["a"].precision, got["a"].recall, got["a"].support) == (0.75, 0.75, 4)
    assert (got["c"].precision, got["c"].recall, got["c"].f1) == (0.0, 0.0, 0.0)
    assert got["avg / total"].recall == pytest.approx(5 / 7)
    assert M.macro_f1(df).first().macro_f1 == pytest.approx((0.75 + 0.8 + 0.0) / 3)


def test_salted_join_equals_broadcast_join(spark, monkeypatch, fitted, train):
    want = sorted(X.transform_tfidf(train, fitted, "id", P.FIELDS).collect())
    monkeypatch.setattr(L, "BROADCAST_ROWS", 2)
    got = sorted(X.transform_tfidf(train, fitted, "id", P.FIELDS).collect())
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r.weight for r in got] == pytest.approx([r.weight for r in want])


def test_lemma_join_equals_literals(spark, monkeypatch):
    from doctag.functions.tokens import lemmatize

    df = spark.createDataFrame([(1, ["jobs", "zoos", "x"]), (2, []), (3, ["jobs", "jobs"])], "id long, t array<string>")
    table = {"jobs": "job", "zoos": "zoo"}
    want = [r.t for r in df.withColumn("t", lemmatize(F.col("t"), table)).orderBy("id").collect()]
    lemmas = spark.createDataFrame(list(table.items()), "token string, lemma string")
    for bound in (10, 1):
        monkeypatch.setattr(L, "BROADCAST_ROWS", bound)
        got = L.lemmatize_by_join(df, "id", "t", lemmas).orderBy("id").collect()
        assert [r.t for r in got] == want
    stops = spark.createDataFrame([("jobs",)], "token string")
    got = L.drop_words_by_join(df, "id", "t", stops).orderBy("id").collect()
    assert [r.t for r in got] == [["zoos", "x"], [], []]


def test_a_fit_counts_only_terms_that_may_reach_the_lower_limit(spark):
    rows = [(i, f"a|t{i}", "|".join(["b", f"x{i}", f"y{i}", f"y{i}", "c" if i % 2 else "d"])) for i in range(400)]
    rows += [(None, None, None), (7, "", ""), (7, "a", "b")]
    df = spark.createDataFrame(rows, "id long, title_seg string, desc_seg string").repartition(5)
    everything = {tuple(r) for r in X.field_document_frequency(df, P.FIELDS).collect()}
    got = {tuple(r) for r in X.frequent_document_frequency(df, P.FIELDS, {"title": 3, "desc": 8}, 403).collect()}
    assert got <= everything and len(got) < 20 < len(everything)
    assert {r for r in everything if r[2] >= 8} <= got
    # Without a lower limit nothing is left out.
    assert {tuple(r) for r in X.frequent_document_frequency(df, P.FIELDS, {"title": 1, "desc": 8}, 403).collect()} == everything
    fitted = X.fit_tfidf(df, P.FIELDS, 1.0, {"title": 3, "desc": 8})
    want = {r for r in everything if r[2] >= (3 if r[0] == "title" else 8)}
    assert {(r.field, r.term, r.df) for r in fitted.terms.collect()} == want


def test_weights_meet_the_vocabulary_before_they_are_shuffled(train, fitted):
    plan = X.transform_tfidf(train, fitted, "id", P.FIELDS)._jdf.queryExecution().toString()
    plan = plan[plan.rindex("== Physical Plan ==") :]
    # From the last operator to the first: the exchange stands above the join.
    assert plan.index("Exchange hashpartitioning(id") < plan.index("BroadcastHashJoin")


def test_top_vocabulary_counts_only_what_may_be_in_it(spark):
    rows = [(i, ["a", "b", f"x{i}"] + ["c"] * (i % 3 == 0)) for i in range(300)] + [(7, []), (7, None)]
    df = spark.createDataFrame(rows, "id long, words array<string>")
    counts = V.document_frequency(df, F.col("words"))
    least = V.kth_frequency(counts, 3)
    assert least == 100 and V.kth_frequency(counts, 1000) == 1
    some = V.document_frequency(df, F.col("words"), least)
    assert some.count() < 10 < counts.count()
    assert V.top_vocabulary(some, 3).collect() == V.top_vocabulary(counts, 3).collect()


def _physical(df):
    plan = df._jdf.queryExecution().toString()
    return plan[plan.rindex("== Physical Plan ==") :]


def test_keyed_weights_move_no_more(spark, fitted):
    from doctag.session import by_key

    rows = [*TRAIN, (1, "dev|dev", "java|cook", "1"), (None, "sql", "food|food", "0"), (None, "dev", "", "0"), (8, None, "java", "0")]
    df = spark.createDataFrame(rows, "id long, title_seg string, desc_seg string, tag string")
    keyed = X.transform_tfidf(by_key(df, "id"), fitted, "id", P.FIELDS, keyed=True)
    plan = _physical(keyed)
    assert plan.count("Exchange hashpartitioning(") == 1 < plan.count("Aggregate(")
    order = lambda r: (r.id is None, r.id or 0, r.field, r.term, r.weight)
    want = sorted(X.transform_tfidf(df, fitted, "id", P.FIELDS).collect(), key=order)
    got = sorted(keyed.collect(), key=order)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r.weight for r in got] == pytest.approx([r.weight for r in want])


def test_stored_words_are_texts_and_a_fit_does_not_move_them(spark):
    from doctag.operators.dataset import tokenize_documents
    from doctag.plans.catalog import features as T

    rows = [(1, "Sql dev", "Sql dev. Sql dev"), (1, "", ""), (None, None, None), (2, " . ", "กข คง"), (3, "a|b", "x\ny")]
    df = spark.createDataFrame(rows, "doc_id long, title string, desc string")
    want = tokenize_documents(df, T.N_TITLE, T.N_DESC).drop("title", "desc")
    as_files, keyed = T.segmented_once(df)
    assert "Exchange" not in _physical(as_files)
    plan = _physical(keyed)
    assert plan.count("Exchange hashpartitioning(doc_id") == 1 and "struct<doc_id:bigint,title:string,desc:string>" in plan
    for got in (as_files, keyed):
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_vectors_keep_no_texts(spark, tmp_path):
    from doctag.plans.catalog import models

    rows = [(i, f"sql w{i % 3} x{i % 5}", None, None, None) for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    train, _ = models.vectors(spark, str(tmp_path))
    assert set(train.columns) == {"doc_id", "features", "tag"} and train.count() == 20


def test_vectors_are_made_once_and_arrays_are_the_token_texts(spark, tmp_path):
    from doctag.plans.catalog import features as T
    from doctag.plans.catalog import models

    rows = [(i, f"Sql dev. w{i % 3} x{i % 5}\nb c" if i < 18 else "", None, None, None) for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    _, vectors = models.vectors(spark, str(tmp_path))
    plan = _physical(vectors)
    assert "UDF(" not in plan and "Exchange" not in plan
    df = T.docs(spark, str(tmp_path))
    (seg, _), (arrays, keyed) = T.segmented_once(df), T.segmented_once(df, arrays=True)
    want = P.vectorize(seg, P.vectorizer(T.fitted(seg))).select("doc_id", "features")
    for own in (vectors, P.vectorize(keyed, P.vectorizer(T.fitted(arrays), arrays=True)).select("doc_id", "features")):
        # The order of equally frequent terms in a vector is the fit's own.
        lists = [sorted((r.doc_id, sorted(map(float, r.features.toArray()))) for r in x.collect()) for x in (own, want)]
        assert [d for d, _ in lists[0]] == [d for d, _ in lists[1]]
        for (_, a), (_, b) in zip(*lists):
            assert a == pytest.approx(b)
