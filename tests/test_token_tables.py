"""Word tables in the token chain against the same words as settings."""

import random

import pytest
from doctag.functions.segment import dictionary_segmenter, longest_match
from doctag.functions.tokens import TokenOptions, tokenize
from doctag.operators import token_tables as X
from pyspark.sql import functions as F

WORDS = ["กข", "กขค", "ข", "คง", "งจฉ", "จ", "ขคงจ"]
LEMMAS = {"ores": "ore", "ones": "one", "zed": "z", "key": "lock", "des": "de"}


def drawn(n=40):
    rng = random.Random(2)
    parts = ["Ores", "ones", "the", "The", "zed", "key", "des", "x1", "กขคงจฉ", "งจฉกข", "คงx", "ก", "a\\b", "ขข", "เ"]
    text = lambda k: " ".join(rng.choices(parts, k=rng.randrange(k)))
    return [(i, text(4), text(30), "kept") for i in range(n)] + [(n, None, "", None)]


@pytest.mark.parametrize("split", [False, True])
def test_tables_do_what_settings_do(spark, monkeypatch, split):
    if split:
        monkeypatch.setattr(X, "fits_broadcast", lambda df: False)
        monkeypatch.setattr(X, "SHARE", 10)
    df = spark.createDataFrame(drawn(), "doc long, title string, desc string, n string")
    keywords = ("key",)
    tables = X.TokenTables(
        stops=spark.createDataFrame([("the",), ("x1",), ("the",)], "token string"),
        lemmas=spark.createDataFrame([*LEMMAS.items(), ("ores", "zzz")], "token string, lemma string"),
        words=spark.createDataFrame([(w,) for w in WORDS], "word string"),
        stops_th=spark.createDataFrame([("จ",), ("nothing",)], "token string"),
    )
    columns = {"a": ("title", 1), "b": ("desc", 3)}
    out = X.tokenize_by_tables(df, "doc", columns, tables, TokenOptions(keywords=keywords, stop_en=("des",)))
    assert out.columns == [*df.columns, "a", "b"]
    base = TokenOptions(
        stop_en=("the", "x1", "des"), lemmas=LEMMAS, keywords=keywords, segmenter=dictionary_segmenter(WORDS), stop_th=("จ",)
    )
    import dataclasses

    want = df.select("doc", *[tokenize(F.col(c), dataclasses.replace(base, ngram=n)).alias(o) for o, (c, n) in columns.items()])
    rows = lambda d: {r.doc: (r.a, r.b) for r in d.select("doc", "a", "b").collect()}
    got, wanted = rows(out), rows(want)
    for doc, pair in wanted.items():
        assert [x or [] for x in got[doc]] == [x or [] for x in pair], doc
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_no_tables_and_no_rows(spark):
    df = spark.createDataFrame(drawn(), "doc long, title string, desc string, n string")
    none = X.TokenTables()
    got = X.tokenize_by_tables(df, "doc", {"t": ("desc", 2)}, none).select("doc", "t")
    want = df.select("doc", tokenize(F.col("desc"), TokenOptions(ngram=2)).alias("t"))
    assert {r.doc: r.t for r in got.collect()} == {r.doc: r.t for r in want.collect()}
    assert X.tokenize_by_tables(df.limit(0), "doc", {"t": ("desc", 2)}, none).collect() == []


def test_segments_of_tokens(spark):
    rng = random.Random(3)
    tokens = sorted({"".join(rng.choices("กขคงจฉx", k=rng.randrange(1, 30))) for _ in range(80)} | {"ก" * 2000 + "ข"})
    df = spark.createDataFrame([(t,) for t in tokens], "token string")
    for words in (WORDS, ["ก"], []):
        table = spark.createDataFrame([(w,) for w in words], "word string")
        got = {r.token: r.pieces for r in X.segmented(df, table).collect()}
        assert got == {t: longest_match(words)(t) for t in tokens}


def test_tokens_are_joined_and_regrouped_where_their_document_lies(spark, tmp_path):
    from doctag.plans.catalog import QUERIES

    # More files than twice the cores are left as they lie by a narrow plan.
    n = 2 * spark.sparkContext.defaultParallelism + 1
    rows = [(i, f"the ores {i}", None) for i in range(2 * n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(n, "doc_id")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "the of")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        for name, first in (("lemmas_by_join", "the|ore|0"), ("stop_words_by_join", "ores|0")):
            out = QUERIES[name].run(spark, str(tmp_path))
            plan = out._jdf.queryExecution().executedPlan().toString()
            own = [line for line in plan.splitlines() if "Exchange hashpartitioning(doc_id" in line]
            assert own and all("REPARTITION_BY_NUM" in line for line in own)
            # The words are made once, not for a test of their number too.
            assert not [line for line in plan.splitlines() if "Filter" in line and "size(" in line]
            assert min(map(tuple, out.collect())) == (0, first)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
