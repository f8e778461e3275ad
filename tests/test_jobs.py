import json

import pytest
from pyspark.sql import functions as F

from doctag.plans import jobs as J
from doctag.functions.tokens import TokenOptions, token_record
from doctag.operators.dataset import preprocess
from doctag.operators.token_tables import TokenTables, preprocess_by_tables
from doctag.sources.documents import write_snapshot

IT = ["java sql developer", "python developer", "java tester", "sql analyst"]
FOOD = ["head cook", "kitchen cook", "baker", "cook and baker", "waiter", "bar waiter"]
DOCS = [{"title": t, "desc": f"we need a {t} now", "tag": "IT"} for t in IT] + [
    {"title": t, "desc": f"wanted {t} for hotel", "tag": "FOOD"} for t in FOOD
]


def test_vocabulary_job(spark, tmp_path):
    (tmp_path / "in.json").write_text("\n".join(map(json.dumps, DOCS)))
    J.vocabulary_job(spark, str(tmp_path / "in.json"), "title", str(tmp_path / "out"), 2)
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("rank").collect()
    assert (rows[0].token, rows[0].frequency, rows[0]["rank"]) == ("cook", 3, 1)
    order = [(-r.frequency, r.token) for r in rows]
    assert order == sorted(order) and [r["rank"] for r in rows] == list(range(1, len(rows) + 1))


def test_rule_job(spark, tmp_path):
    rules = [
        dict(title_inc="java", title_exc="", desc_inc="", desc_exc="", level=1, tag="J", suppress=False),
        dict(title_inc="sql", title_exc="", desc_inc="", desc_exc="", level=1, tag="S", suppress=False),
    ]
    (tmp_path / "in.json").write_text(json.dumps(DOCS + DOCS))
    (tmp_path / "rules.json").write_text(json.dumps(rules))
    args = str(tmp_path / "in.json"), str(tmp_path / "rules.json")
    counts = J.rule_job(spark, *args, 3, str(tmp_path / "out"))
    assert counts == {"not_found": 14, "conflict": 2, "unique": 4}
    report = spark.read.json(str(tmp_path / "out")).groupBy("outcome").count().collect()
    assert {r.outcome: r["count"] for r in report} == {"not_found": 3, "conflict": 2, "unique": 3}
    only = J.rule_job(spark, *args, 3, str(tmp_path / "two"), titles=["sql"])
    assert only == {"not_found": 0, "conflict": 2, "unique": 2}


def test_train_and_predict(spark, tmp_path):
    docs = spark.createDataFrame([(i, d["title"], d["desc"], d["tag"]) for i, d in enumerate(DOCS)], "doc long, title string, desc string, tag string")
    J.training_job(spark, docs, "doc", "IT", str(tmp_path / "models"))
    write_snapshot(preprocess(docs), str(tmp_path / "docs"))
    J.prediction_job(spark, str(tmp_path / "docs"), str(tmp_path / "models"), str(tmp_path / "all"))
    done = spark.read.json(str(tmp_path / "all"))
    assert "title_seg" not in done.columns
    right = done.filter((F.col("tag") == "IT") == (F.col("predict") == "IT")).count()
    assert right >= 9
    J.prediction_job(spark, str(tmp_path / "docs"), str(tmp_path / "models"), str(tmp_path / "it"), "IT")
    assert {r.predict for r in spark.read.json(str(tmp_path / "it")).collect()} == {"IT"}


def test_vectorizer_job(spark, tmp_path):
    (tmp_path / "in.json").write_text(json.dumps(DOCS))
    options = TokenOptions(cleaner=lambda c: F.upper(c))
    model = J.vectorizer_job(spark, str(tmp_path / "in.json"), str(tmp_path / "v"), 2, 1, options=options)
    again = J.P.load_model(str(tmp_path / "v"))
    assert again.stages[1].vocabulary == model.stages[1].vocabulary
    assert "java sql" in model.stages[1].vocabulary and "java sql" not in model.stages[4].vocabulary


def test_review_job(spark, tmp_path):
    rows = [(i, "old", "IT" if i % 2 else "X") for i in range(20)]
    write_snapshot(spark.createDataFrame(rows, "doc long, tag string, predict string"), str(tmp_path / "p"))
    codes = spark.createDataFrame([(3, "+"), (5, "-"), (7, "."), (9, "?"), (11, "")], "doc long, code string")
    rejected = J.review_job(
        spark, str(tmp_path / "p"), codes, str(tmp_path / "out"), "doc", "D", "P", "N", label="IT", begin=2, end=14
    )
    got = {r.doc: r.tag for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {3: "P", 5: "N", 7: "not sure", 9: "old", 11: "D", 13: "old"}
    assert [r.doc for r in rejected.collect()] == [9]


def test_long_form_jobs(spark, tmp_path):
    docs = spark.createDataFrame([(i, d["title"], d["desc"], d["tag"]) for i, d in enumerate(DOCS)], "doc long, title string, desc string, tag string")
    J.long_training_job(spark, docs, "doc", "IT", str(tmp_path / "models"), min_df={"title": 1, "desc": 2})
    write_snapshot(preprocess(docs, key="doc"), str(tmp_path / "docs"))
    J.long_prediction_job(spark, str(tmp_path / "docs"), str(tmp_path / "models"), str(tmp_path / "all"), "doc")
    done = spark.read.json(str(tmp_path / "all"))
    assert done.count() == len(DOCS) and "title_seg" not in done.columns
    assert done.filter((F.col("tag") == "IT") == (F.col("predict") == "IT")).count() >= 9


def test_jobs_take_frames_and_lines(spark, tmp_path):
    docs = spark.createDataFrame([(d["title"], d["desc"], d["tag"]) for d in DOCS], "title string, desc string, tag string")
    (tmp_path / "in.json").write_text("\n".join(map(json.dumps, DOCS)))
    a = J.vectorizer_job(spark, docs, str(tmp_path / "a"), 2, 1)
    b = J.vectorizer_job(spark, str(tmp_path / "in.json"), str(tmp_path / "b"), 2, 1, form="lines")
    assert sorted(a.stages[1].vocabulary) == sorted(b.stages[1].vocabulary)


def test_models_refuse_texts_of_other_options(spark, tmp_path):
    docs = spark.createDataFrame([(i, d["title"], d["desc"], d["tag"]) for i, d in enumerate(DOCS)], "doc long, title string, desc string, tag string")
    J.long_training_job(spark, docs, "doc", "IT", str(tmp_path / "long"), min_df={"title": 1, "desc": 2})
    J.training_job(spark, docs, "doc", "IT", str(tmp_path / "vectors"))
    write_snapshot(preprocess(docs, TokenOptions(ngram=2), key="doc"), str(tmp_path / "other"))
    plain = [F.col(c).alias(c, metadata={}) if c.endswith("_seg") else c for c in preprocess(docs, key="doc").columns]
    write_snapshot(preprocess(docs, key="doc").select(*plain), str(tmp_path / "untold"))
    for name in ("other", "untold"):
        with pytest.raises(ValueError, match="title_seg, desc_seg: token texts made with other options"):
            J.long_prediction_job(spark, str(tmp_path / name), str(tmp_path / "long"), str(tmp_path / "x"), "doc")
        with pytest.raises(ValueError, match="other options"):
            J.prediction_job(spark, str(tmp_path / name), str(tmp_path / "vectors"), str(tmp_path / "x"))
    with pytest.raises(ValueError, match="no complete model"):
        J.long_prediction_job(spark, str(tmp_path / "other"), str(tmp_path / "missing"), str(tmp_path / "x"), "doc")


def test_token_records():
    a = TokenOptions(ngram=2, lemmas={"a": "b", "c": "d"}, cleaner=F.upper)
    same = TokenOptions(ngram=2, lemmas={"c": "d", "a": "b"}, cleaner=F.upper)
    assert token_record(a) == token_record(same)
    others = [TokenOptions(ngram=3, lemmas=a.lemmas, cleaner=F.upper), TokenOptions(ngram=2, lemmas=a.lemmas), TokenOptions(ngram=2, cleaner=F.upper), TokenOptions()]
    assert len({token_record(o) for o in (a, *others)}) == 5


def test_long_form_jobs_with_word_tables(spark, tmp_path):
    docs = spark.createDataFrame([(i, d["title"], d["desc"], d["tag"]) for i, d in enumerate(DOCS)], "doc long, title string, desc string, tag string")
    lemmas = spark.createDataFrame([("developer", "maker"), ("cook", "maker")], "token string, lemma string")
    tables = TokenTables(stops=spark.createDataFrame([("we",), ("a",)], "token string"), lemmas=lemmas)
    J.long_training_job(spark, docs, "doc", "IT", str(tmp_path / "models"), min_df={"title": 1, "desc": 2}, tables=tables)
    terms = {r.term for r in spark.read.parquet(str(tmp_path / "models/tfidf/terms")).collect()}
    assert "maker" in terms and not {"developer", "cook", "we"} & terms
    write_snapshot(preprocess_by_tables(docs, "doc", tables), str(tmp_path / "docs"))
    J.long_prediction_job(spark, str(tmp_path / "docs"), str(tmp_path / "models"), str(tmp_path / "all"), "doc")
    assert spark.read.json(str(tmp_path / "all")).count() == len(DOCS)
    other = TokenTables(stops=tables.stops, lemmas=lemmas.limit(1))
    write_snapshot(preprocess_by_tables(docs, "doc", other), str(tmp_path / "other"))
    with pytest.raises(ValueError, match="other options"):
        J.long_prediction_job(spark, str(tmp_path / "other"), str(tmp_path / "models"), str(tmp_path / "x"), "doc")
