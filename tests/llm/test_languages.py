"""Language identification: the kernel against sets, the model on held-out rows."""

import unicodedata

import numpy as np
import pytest
from doctag.llm import languages
from pyspark.sql import functions as F

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def plain_grams(text):
    """All n-grams of a text, as strings."""
    kept = "".join(
        (c.lower() if len(c.lower()) == 1 else c) if unicodedata.category(c)[0] in "LM" else " " for c in text or ""
    )
    kept = " " + " ".join(kept.split(" "))
    kept = " " + " ".join(kept.split()) + (" " if kept.split() else "")
    return {kept[i : i + n] for n in range(1, languages.LONGEST + 1) for i in range(len(kept) - n + 1)}


TEXTS = ["The cat, the CAT!", "", None, "42", "é È", "a", "ไทยภาษา ไทย", "x\ny  z--z", "İstanbul", "the " * 40, "übeŕ"]


@pytest.mark.parametrize("size", [1 << 18, 5])
def test_presences_and_kernel_are_those_of_sets(monkeypatch, size):
    monkeypatch.setattr(languages, "SLICE", size)
    keys = []
    for text in TEXTS:
        own = [np.zeros(0, np.uint64)]
        for codes, rows, _ in languages.normal([text]):
            own += [k for k, _ in languages.grams(codes, rows)]
        keys.append(np.unique(np.concatenate(own)))
        assert len(keys[-1]) == len(plain_grams(text)), text
    spectrum = languages.Spectrum(np.unique(np.concatenate(keys)))
    found, letters = spectrum.presences(TEXTS)
    assert letters.tolist() == [any(c.isalpha() for c in t or "") for t in TEXTS]
    sets = [plain_grams(t) for t in TEXTS]
    want = [[len(a & b) / np.sqrt(max(1, len(a) * len(b))) for b in sets] for a in sets]
    assert np.allclose(languages.kernel(found, found), want)


def test_crowded_tables(monkeypatch):
    """Keys that share their slots in every table are found, unknown ones are not."""
    monkeypatch.setattr(languages, "TABLE", 6)
    keys = np.random.default_rng(0).integers(0, 1 << 63, 1000).astype(np.uint64)
    spectrum = languages.Spectrum(keys[:500])
    assert spectrum.rest
    assert spectrum.places(keys).tolist() == [*range(500), *[500] * 500]


def test_folded_scores_are_kernel_scores():
    """Presences times folded weights equal the kernel with the landmarks times theirs; the
    regression equals kernel ridge regression in the span of the landmarks."""
    rng = np.random.default_rng(2)
    found = (rng.random((60, 200)) < 0.2).astype(np.uint8)
    at, y = found[:10], np.arange(60) % 3
    x = languages.kernel(found, at)
    weights, _ = languages.regress(languages.kernel(at, at), x, y, 3, np.zeros(60, bool))
    folded = (at / np.sqrt(np.maximum(at.sum(1, keepdims=True), 1))).T @ weights
    assert np.allclose(languages.margins(found, folded), x @ weights, atol=1e-4)
    target = np.where(y[:, None] == np.arange(3), 1.0, -1.0)
    k = languages.kernel(at, at)
    # The minimum of |x a - t|^2 + ridge n a' k a.
    gradient = x.T @ (x @ weights - target) + languages.RIDGE * 60 * k @ weights
    assert np.abs(gradient).max() < 1e-6


@pytest.mark.parametrize("sf_dir", [SMALL, MEDIUM])
def test_held_out_accuracy(spark, sf_dir):
    out = languages.op12_language(spark, sf_dir)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = out.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    tested = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert sum(r.lang == r.lang_pred for r in tested) >= 0.98 * len(tested)
    assert all(0 <= r.score <= 1 for r in rows)


def test_predictions_do_not_see_the_labels_of_the_held_out_fold(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    other = docs.withColumn("lang", F.when(languages.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    results = []
    for some in (docs, other.repartition(3)):
        out = languages.identify(docs, languages.fit(some))
        results.append(sorted((r.doc_id, r.lang_pred, round(r.score, 5)) for r in out.collect()))
    assert results[0] == results[1]


def test_defined_cases(spark):
    schema = "doc_id long, text string, lang string, score string, lang_pred int"
    known = [(i, f"the house number {i} is there", "en", "s", 1) for i in range(40)]
    known += [(100 + i, f"das Haus Nummer {i} ist dort", "de", "s", 1) for i in range(30)]
    odd = [
        (900, None, "en", "s", 1), (901, "", "en", "s", 1), (902, "12 .. 7", None, "s", 1), (903, "ヴァイオリン", None, "s", 1),
        (None, "das Haus ist dort", "xx", "s", 1), (905, "das Haus " * 80_000, None, "s", 1), (905, "the house", None, "s", 1),
        (905, "the house", None, "s", 1),
    ]
    docs = spark.createDataFrame(known + odd, schema)
    model = languages.fit(docs)
    assert sorted(model.languages) == ["de", "en"]
    out = languages.identify(docs, model)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    got = [(r.lang_pred, r.score) for r in out.collect()][-8:]
    assert got[:3] == [("und", 0.0)] * 3
    assert [g[0] for g in got[3:]] == ["en", "de", "de", "en", "en"] and got[6] == got[7]
    # Nothing to learn from, and nothing to judge.
    nothing = languages.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in languages.identify(docs, nothing).collect()} == {("und", 0.0)}
    assert languages.identify(docs.limit(0), model).collect() == []
    assert languages.fit(docs.limit(0)).languages == []


def test_more_languages_than_are_learnt(spark, monkeypatch):
    monkeypatch.setattr(languages, "MAX_LANGUAGES", 2)
    rows = [(i, f"word{'abc'[i % 3] * 4} {i}", "abc"[i % 3], 1) for i in range(60)] + [(99, "more aaaa", "a", 1), (98, "bbbb", "b", 1)]
    model = languages.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string, n int"))
    assert len(model.languages) == 2
