import json

import pytest
from pyspark.sql import functions as F

from doctag.operators.rules import rule_book
from doctag.schema import document_set_schema
from doctag.sources import documents as D
from doctag.sources import lists as L
from doctag.streaming.documents import read_document_stream, tag_stream

DOCS = [
    {"title": "งาน Sales", "desc": "ขาย", "tag": "1"},
    {"title": "Dev", "desc": "a\nb", "tag": "0"},
]


def raw(df):
    return sorted((r.title, r.desc, r.tag) for r in df.collect())


WANT = sorted((d["title"], d["desc"], d["tag"]) for d in DOCS)


def test_json_lines_and_arrays(spark, tmp_path):
    (tmp_path / "l.json").write_text("\n".join(json.dumps({**d, "x": 1}) for d in DOCS), "utf-8")
    (tmp_path / "a.json").write_text(json.dumps(DOCS, ensure_ascii=False), "utf-8")
    assert raw(D.read_json_lines(spark, str(tmp_path / "l.json"))) == WANT
    assert raw(D.read_json_array(spark, str(tmp_path / "a.json"))) == WANT


def test_bad_line_is_an_error(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"title": "x"\n')
    with pytest.raises(Exception):
        D.read_json_lines(spark, str(tmp_path / "bad.json")).collect()


def test_records_keep_other_letters(spark, tmp_path):
    D.write_json_records(D.documents(spark, DOCS), str(tmp_path / "out"))
    text = "".join(p.read_text("utf-8") for p in (tmp_path / "out").glob("part-*"))
    assert "งาน Sales" in text
    assert raw(D.read_json_lines(spark, str(tmp_path / "out"))) == WANT


def test_documents_in_memory(spark):
    assert raw(D.documents(spark, DOCS)) == WANT
    blank = D.documents(spark, add_column="note")
    assert blank.count() == 0 and blank.columns[-1] == "note"
    with pytest.raises(TypeError):
        D.documents(spark, 5)
    with pytest.raises(TypeError):
        document_set_schema(5)
    with pytest.raises(KeyError):
        D.documents(spark, [{"title": "x"}])


def test_word_lists_and_charset(spark, tmp_path):
    (tmp_path / "w").write_text("the\nงาน\n", "utf-8")
    assert L.read_word_list(spark, str(tmp_path / "w")) == {"the", "งาน", ""}
    assert {r.token for r in L.read_word_table(spark, str(tmp_path / "w")).collect()} == {"the", "งาน"}
    (tmp_path / "c").write_text("0020\n#\nA\n0E01\n", "utf-8")
    assert L.read_charset(spark, str(tmp_path / "c")) == {" ", "#", "A", "ก"}


def test_own_charset(spark, tmp_path, column):
    from doctag.functions.clean import drop_illegal

    legal = frozenset("ab ")
    assert column(["abc a-b"], lambda c: drop_illegal(c, legal)) == ["ab ab"]


def test_rule_file(spark, tmp_path):
    rows = [
        dict(title_inc="a", title_exc="", desc_inc="", desc_exc="", level=1, tag=f"t{i}", suppress=i == 1)
        for i in range(5)
    ]
    (tmp_path / "r.json").write_text(json.dumps(rows))
    assert L.read_rule_book(spark, str(tmp_path / "r.json")) == rule_book(rows)


def test_stream_equals_batch(spark, tmp_path):
    from doctag.operators.rules import tag_documents

    book = rule_book([dict(title_inc="Dev", title_exc="", desc_inc="", desc_exc="", level=1, tag="IT", suppress=False)])
    D.write_json_records(D.documents(spark, DOCS), str(tmp_path / "in"))
    stream = read_document_stream(spark, str(tmp_path / "in"))
    tag_stream(stream, book, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = D.read_snapshot(spark, str(tmp_path / "out")).select("title", "match", "predict_tag")
    want = tag_documents(D.documents(spark, DOCS), book).select(got.columns)
    assert sorted(got.collect()) == sorted(want.collect())


def test_report_folders(spark, tmp_path):
    df = spark.range(4).select("id", F.when(F.col("id") < 2, "unique").otherwise("conflict").alias("outcome"))
    D.write_report(df, str(tmp_path / "rep"))
    assert {p.name for p in (tmp_path / "rep").glob("outcome=*")} == {"outcome=unique", "outcome=conflict"}


def test_a_missing_field_is_an_error(spark, tmp_path):
    (tmp_path / "l.json").write_text('{"title": "x", "tag": null, "desc": "y"}\n{"title": "x", "tag": "1"}\n')
    with pytest.raises(Exception, match="without desc"):
        D.read_json_lines(spark, str(tmp_path / "l.json")).collect()
    (tmp_path / "a.json").write_text('[{"title": "x", "tag": "1"}]')
    with pytest.raises(Exception, match="without desc"):
        D.read_json_array(spark, str(tmp_path / "a.json")).collect()
    assert D.read_json_array(spark, str(tmp_path / "a.json"), required=["title"]).first().desc is None


def test_null_fields_are_kept(spark, tmp_path):
    D.write_json_records(D.documents(spark, [{"title": "x", "desc": None, "tag": None}]), str(tmp_path / "out"))
    assert raw(D.read_json_lines(spark, str(tmp_path / "out"))) == [("x", None, None)]


def test_folders_of_word_files(spark, tmp_path):
    for name, text in (("a", "one\ntwo"), ("b", "three\n0041")):
        (tmp_path / name).write_text(text)
    assert L.read_word_list(spark, str(tmp_path)) == {"one", "two", "three", "0041"}
    assert L.read_charset(spark, str(tmp_path)) == {"A"}


@pytest.mark.parametrize("text", ['[{"title_inc": "a", "level": 1', '{"level": 1}x', "", '[{"title_inc": "a"}]'])
def test_a_broken_rule_file_is_an_error(spark, tmp_path, text):
    (tmp_path / "r.json").write_text(text)
    with pytest.raises(Exception):
        L.read_rule_book(spark, str(tmp_path / "r.json"))


def test_levels_as_texts_and_null_suppress(spark, tmp_path):
    from doctag.operators.rules import parse_rules, tag_documents

    row = dict(title_inc="D", title_exc="", desc_inc="", desc_exc="")
    rows = [{**row, "level": "a", "tag": "LOW", "suppress": None}, {**row, "level": "b", "tag": "TOP", "suppress": False}]
    (tmp_path / "r.json").write_text(json.dumps(rows))
    book = L.read_rule_book(spark, str(tmp_path / "r.json"))
    assert book.levels == ["b", "a"]
    got = tag_documents(D.documents(spark, DOCS), book).filter("title = 'Dev'").first()
    assert (got.predict_tag, got.rule_nos) == ("TOP", [2])
    table = L.read_rule_rows(spark, str(tmp_path / "r.json"))
    assert parse_rules(table, [F.col("position")]).count() == 2


def test_patterns_search_as_plain_expressions(spark):
    import random
    import re

    from doctag.operators.rules import found

    rng = random.Random(3)
    texts = ["".join(rng.choice("กขคงจ aZé9_ .-") for _ in range(12)) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for pattern in (r"^\w+ ", r"\bก\w", r"[^\s]\W", r"\d\b", r"é\w?$", r"(?P<x>ก|ข)(?P=x)", r"\Sข\S", r"a\Db"):
        got = [r.x for r in df.select(found(F.col("t"), pattern).alias("x")).collect()]
        assert got == [bool(re.search(pattern, t)) for t in texts], pattern


def test_ids_of_copies_differ(spark):
    from doctag.operators.dataset import document_id, not_sampled

    df = spark.range(6).select("id", F.lit("a").alias("title"), F.when(F.col("id") > 3, "b").alias("desc"))
    for key in ("id", None):
        ids = [r.x for r in df.select(document_id("s", key).alias("x")).collect()]
        assert len(set(ids)) == 6 and None not in ids
    marks = df.withColumn("sampled", F.when(F.col("id") == 0, True).when(F.col("id") == 1, False))
    assert not_sampled(marks).count() == 5


def test_stored_tfidf_keeps_its_limits(spark, tmp_path):
    from doctag.operators.tfidf import fit_tfidf, load_tfidf, save_tfidf

    df = spark.createDataFrame([(i, f"a|b{i % 2}", "x|y") for i in range(8)], "id long, t string, d string")
    model = fit_tfidf(df, {"title": "t", "desc": "d"}, {"title": 0.9, "desc": 1.0}, {"title": 3, "desc": 1})
    assert {(r.field, r.term) for r in model.terms.collect()} == {("title", "b0"), ("title", "b1"), ("desc", "x"), ("desc", "y")}
    save_tfidf(model, str(tmp_path / "m"))
    again = load_tfidf(spark, str(tmp_path / "m"))
    assert (again.n_docs, again.fields, again.limits) == (model.n_docs, model.fields, model.limits)
    assert sorted(again.terms.collect()) == sorted(model.terms.collect())
