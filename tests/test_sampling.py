import pytest
from pyspark.sql import functions as F

from doctag.operators import dataset as D
from doctag.operators import order as O
from doctag.operators import sampling as S


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(1000).selectExpr(
        "id", "cast(case when id % 10 < 7 then 'a' when id % 10 < 9 then 'b' end as string) as tag"
    )


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


@pytest.mark.parametrize("n", [0, 1, 17, 999, 1000, 5000])
def test_sample_size_is_exact(rows, n):
    assert S.sample_exact(rows, "id", n, 4).count() == min(n, 1000)


def test_sample_is_stable_under_repartition(rows):
    a = ids(S.sample_exact(rows, "id", 100, 9))
    assert a == ids(S.sample_exact(rows.repartition(13), "id", 100, 9))
    assert a != ids(S.sample_exact(rows, "id", 100, 10))


def test_samples_without_repetition_are_disjoint(spark, rows):
    ledger = spark.createDataFrame([], "id long")
    seen = set()
    for step in range(4):
        drawn, ledger = S.sample(rows, "id", 300, step, ledger=ledger)
        got = set(ids(drawn))
        assert not got & seen
        seen |= got
    assert len(seen) == 1000 and ids(ledger) == list(range(1000))


def test_sample_all_ignores_marks(rows):
    marked = rows.withColumn("sampled", F.lit(True))
    assert S.sample(marked, "id")[0].count() == 1000
    assert S.sample(marked, "id", 10)[0].count() == 0
    assert S.sample(marked, "id", 10, repeated=True)[0].count() == 10


def test_fraction_counts_from_the_whole_set(spark, rows):
    ledger = rows.filter("id < 900").select("id")
    assert S.sample(rows, "id", 0.05, ledger=ledger)[0].count() == 50
    assert S.sample(rows, "id", 0.5, ledger=ledger)[0].count() == 100


def test_training_set_is_balanced(rows):
    for label, other in (("a", 300), ("b", 200)):
        got = dict(S.training_set(rows, label, "id", 2).groupBy("tag").count().collect())
        assert got == {label: other, "!" + label: other}


def test_equal_sides_keep_every_row(rows):
    even = rows.withColumn("tag", F.when(F.col("id") % 2 == 0, "x").otherwise("y"))
    assert S.training_set(even, "x", "id").count() == 1000


def test_split_sizes(rows):
    train, test = S.split_exact(rows.filter("id < 101"), "id", 0.3, 1)
    assert test.count() == 31 and train.count() == 70
    assert not set(ids(train)) & set(ids(test))


def test_folds_partition_and_balance(rows):
    out = S.stratified_folds(rows, "id", "tag", 6, 3)
    sizes = {(r.tag, r.fold): r["count"] for r in out.groupBy("tag", "fold").count().collect()}
    for tag, n in (("a", 700), ("b", 200), (None, 100)):
        own = [v for (t, _), v in sizes.items() if t == tag]
        assert len(own) == 6 and sum(own) == n and max(own) - min(own) <= 1


def test_one_fold(rows):
    assert {r.fold for r in S.stratified_folds(rows, "id", "tag", 1).collect()} == {0}


def test_shuffle_splits(rows):
    out = S.shuffle_splits(rows, "id", 5, 0.2, 0)
    sizes = {r.split: r.n for r in out.filter("is_test").groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert sizes == {i: 200 for i in range(5)}
    own = S.split_exact(rows, "id", 0.2, 3)[1]
    assert ids(own) == ids(out.filter("is_test and split = 3"))


def test_row_numbers_with_a_hot_value(spark):
    df = spark.range(5000).selectExpr("id", "case when id % 3 = 0 then 7 else id end as v")
    got = O.with_row_number(df, [F.desc("v"), F.asc("id")], "n").orderBy("n").collect()
    want = sorted(((r.v, r.id) for r in got), key=lambda p: (-p[0], p[1]))
    assert [r.n for r in got] == list(range(1, 5001))
    assert [(r.v, r.id) for r in got] == want


def test_slices(rows):
    assert ids(D.slice_rows(rows, "id", 10, 13)) == [10, 11, 12]
    assert ids(D.slice_rows(rows, "id", 998)) == [998, 999]
    assert ids(D.slice_rows(rows, "id", None, 2)) == [0, 1]
    assert ids(D.slice_rows(rows, "id", 990, 5000)) == list(range(990, 1000))
    assert ids(D.slice_rows(rows, "id", -2)) == [998, 999]
    assert ids(D.slice_rows(rows, "id", 5, 5)) == []
    assert ids(D.slice_rows(rows, "id", 2000)) == []


def test_top_k_with_one_big_group(spark):
    df = spark.range(3000).selectExpr("id", "case when id < 2900 then 'big' else 'small' end g")
    out = O.top_k_per_group(df, ["g"], [F.desc("id")], 3, ["id"])
    assert ids(out) == [2897, 2898, 2899, 2997, 2998, 2999]


def test_selections_end_in_a_plain_filter(rows):
    plan = S.sample_exact(rows, "id", 10)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_append_checks(spark, rows):
    with pytest.raises(ValueError):
        D.append(rows, rows.withColumn("x", F.lit(1)))
    with pytest.raises(TypeError):
        D.append(rows, [rows, "x"])
    with pytest.raises(TypeError):
        D.append(rows, "x")
    assert D.append(rows, [rows.drop("tag"), rows]).count() == 3000


def test_add_columns(spark, rows):
    other = spark.createDataFrame([(1, "p"), (2, "q")], "id long, note string")
    out = D.add_columns(rows.filter("id < 4"), {"b": F.lit(1), "a": F.lit(2)}, other, "id")
    assert out.columns == ["id", "tag", "a", "b", "note"]
    assert [r.note for r in out.orderBy("id").collect()] == [None, "p", "q", None]
    with pytest.raises(ValueError):
        D.add_columns(rows, other=other)


def test_decisions(spark):
    df = spark.createDataFrame([(i, "old") for i in range(6)], "id long, tag string")
    codes = spark.createDataFrame([(0, ""), (1, "+"), (2, "-"), (3, "."), (4, "?")], "id long, code string")
    tagged, rejected = D.apply_decisions(df, codes, "id", "def", "pos", "neg")
    got = [r.tag for r in tagged.orderBy("id").collect()]
    assert got == ["def", "pos", "neg", "not sure", "old", "old"]
    assert ids(rejected) == [4]


def test_key_at(spark, monkeypatch):
    from doctag.operators import order

    monkeypatch.setattr(order, "FEW_KEYS", 5)
    monkeypatch.setattr(order, "PIVOTS", 7)
    for values in ([], [3], list(range(0, 900, 3)), [f"k{i}é" for i in range(200)]):
        kind = "string" if values and isinstance(values[0], str) else "long"
        df = spark.createDataFrame([(v,) for v in values], f"k {kind}")
        for rank in (1, 2, 77, len(values), len(values) + 1):
            want = sorted(values)[rank - 1] if 1 <= rank <= len(values) else None
            if rank >= 1:
                assert order.key_at(df, "k", rank) == want


def test_slices_of_repeated_and_null_keys(spark):
    values = [None] * 3 + [5] * 20_000 + [7] * 4
    rows = spark.createDataFrame([(v, "x") for v in values], "k long, x string")
    count = lambda *ends: sorted((str(r.k), r["count"]) for r in D.slice_rows(rows, "k", *ends).groupBy("k").count().collect())
    assert count(0, 2) == [("None", 3)]
    assert count(1, 10) == [("5", 20_000), ("None", 3)]
    assert count(9_000, 9_001) == [("5", 20_000)]
    assert count(-1, None) == [("7", 4)]
    assert count(20_002, 20_004) == [("5", 20_000), ("7", 4)]
    assert count(30_000, None) == []
    assert count(2, None) == [("5", 20_000), ("7", 4), ("None", 3)]
