"""Quality classifier: held-out accuracy, calibration and edge cases."""

import zlib

import numpy as np
import pyarrow as pa
from doctag.llm import bytetext, quality
from pyspark.sql import functions as F


def corpus(spark, n=600):
    rng = np.random.default_rng(4)
    good, bad = ["the", "river", "of", "stone", "and", "light"], ["buy!!", "NOW", "$$$", "win", "click", "the"]
    rows, labels = [], []
    for i in range(n):
        y = int(rng.random() < 0.6)
        rows.append((i, " ".join(rng.choice(good if y else bad, 30)), "en"))
        labels.append((i, y, 0))
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(
        labels, "doc_id long, quality int, toxic int"
    )


def test_held_out_accuracy_and_repeats(spark):
    docs, labels = corpus(spark)
    model = quality.fit(docs, labels)
    scored = quality.score(docs, model)
    assert scored.columns == ["doc_id", "text", "score", "predicted"]
    rows = scored.withColumn("held", quality.held_out(F.col("doc_id"))).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held]
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.predicted == r.quality for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    again = quality.fit(docs.repartition(7), labels.repartition(3))
    assert np.allclose(again.network.weights[0], model.network.weights[0])


def test_edges(spark):
    docs, labels = corpus(spark, 60)
    odd = spark.createDataFrame([(None, None, None), (900, "", ""), (901, "x" * 3_000_000, ""), (901, "a b", "")], docs.schema)
    labels = labels.unionByName(spark.createDataFrame([(None, 1, None), (900, None, 1), (5000, 0, 0), (901, 0, 0)], labels.schema))
    model = quality.fit(docs.unionByName(odd), labels)
    assert quality.score(docs.unionByName(odd), model).filter("score BETWEEN 0 AND 1").count() == 64
    assert quality.score(docs.limit(0), model).count() == 0
    nothing = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score(odd, nothing).collect()} == {0.5}
    quality.fit(docs.limit(0), labels)


def test_temperature_finds_the_scale():
    rng = np.random.default_rng(0)
    logits = rng.normal(0, 2, 20_000)
    y = (rng.random(20_000) < 1 / (1 + np.exp(-logits))).astype(int)
    assert 2.6 < quality.temperature(3 * logits, y) < 3.5


def test_tokens_do_not_depend_on_the_batch():
    texts = ["Ab12 cd!!", "", None, "é x\n\ty", "z" * 10]
    whole = bytetext.slices(pa.array(texts))
    data, starts, rows = next(whole)
    hashes, piece = bytetext.tokens(data, starts)
    for i, t in enumerate(texts):
        mine = hashes[rows[piece] == i].tolist()
        alone = [bytetext.tokens(d, s)[0].tolist() for d, s, _ in bytetext.slices(pa.array([t], pa.string()))]
        assert mine == (alone[0] if alone else [])
    assert len(hashes) == 4 + 3 + 1


def test_long_texts_are_cut_at_white_space():
    text = "word " * 700_000
    parts = list(bytetext.slices(pa.array([text, "end"])))
    assert len(parts) > 2 and sum(len(d) for d, _, _ in parts) == len(text) + 3
    assert sum(len(bytetext.tokens(d, s)[0]) for d, s, _ in parts) == 700_001


def test_the_driver_gets_unit_vectors_alone(spark, monkeypatch):
    """The sums, twice as long, stay with the tasks."""
    from pyspark.sql.classic.dataframe import DataFrame

    seen, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda df: (seen.append(collect(df)), seen[-1])[1])
    words = quality.word_table(corpus(spark, 40)[0])
    assert sum(len(r.sums) for r in seen[0]) <= words.nbytes == quality.ROWS * quality.DIMENSIONS * 4
    norms = np.linalg.norm(words.astype(float), axis=1)
    assert 0 < (norms > 0).sum() < 20 and np.allclose(norms[norms > 0], 1)
