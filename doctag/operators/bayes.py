"""Multinomial naive Bayes over long-form weights, for vocabularies of any length."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import log

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doctag.operators.lemmas import join_small_or_salted
from doctag.operators.order import top_k_per_group
from doctag.session import durable


@dataclass(frozen=True)
class FittedBayes:
    """``terms``: ``field, term, logp`` with one array entry per class."""

    classes: tuple[str, ...]
    log_prior: tuple[float, ...]
    terms: DataFrame


def class_weights(weights: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """``field, term, tag, weight``: weights summed per class."""
    return (
        weights.join(labels.select(key, "tag"), key)
        .groupBy("field", "term", "tag")
        .agg(F.sum("weight").alias("weight"))
    )


def fit_bayes(
    weights: DataFrame,
    labels: DataFrame,
    vocabulary: DataFrame,
    key: str,
    classes: Sequence[str],
    alpha: float = 1.0,
) -> FittedBayes:
    """Class priors and smoothed log-probabilities. Terms of the vocabulary that
    carry no weight in a class still count with ``alpha``."""
    counts = {r.tag: r["count"] for r in labels.groupBy("tag").count().collect()}
    total = sum(counts[c] for c in classes)
    per_class = [
        F.coalesce(F.sum(F.when(F.col("tag") == c, F.col("weight"))), F.lit(0.0)).alias(f"w{i}")
        for i, c in enumerate(classes)
    ]
    seen = (
        weights.join(labels.select(key, "tag"), key)
        .groupBy("field", "term")
        .agg(*per_class)
    )
    names = [f"w{i}" for i in range(len(classes))]
    dense = durable(
        vocabulary.select("field", "term")
        .join(seen, ["field", "term"], "left")
        .select("field", "term", *[F.coalesce(n, F.lit(0.0)).alias(n) for n in names])
    )
    sums = dense.agg(F.count(F.lit(1)).alias("n"), *[F.sum(n).alias(n) for n in names]).first()
    logp = [
        F.log(F.col(n) + alpha) - F.log(F.lit((sums[n] or 0.0) + alpha * sums["n"])) for n in names
    ]
    terms = dense.select("field", "term", F.array(*logp).alias("logp"))
    return FittedBayes(
        tuple(classes), tuple(log(counts[c] / total) for c in classes), terms
    )


def save_bayes(model: FittedBayes, path: str) -> None:
    """The classes with their priors, and the table of terms."""
    spark = model.terms.sparkSession
    rows = list(zip(range(len(model.classes)), model.classes, model.log_prior))
    spark.createDataFrame(rows, "i int, class string, log_prior double").write.parquet(f"{path}/classes")
    model.terms.write.parquet(f"{path}/terms")


def load_bayes(spark: SparkSession, path: str) -> FittedBayes:
    rows = spark.read.parquet(f"{path}/classes").orderBy("i").collect()
    terms = spark.read.parquet(f"{path}/terms")
    return FittedBayes(tuple(r["class"] for r in rows), tuple(r.log_prior for r in rows), terms)


def score_bayes(weights: DataFrame, model: FittedBayes, key: str) -> DataFrame:
    """``key, scores`` with one joint log-likelihood per class."""
    n = len(model.classes)
    each = join_small_or_salted(weights, model.terms, ["field", "term"], "inner", key)
    sums = [F.sum(F.col("weight") * F.get("logp", F.lit(i))).alias(f"s{i}") for i in range(n)]
    return (
        each.groupBy(key)
        .agg(*sums)
        .select(key, F.array(*[F.col(f"s{i}") + model.log_prior[i] for i in range(n)]).alias("scores"))
    )


def predict_bayes(
    weights: DataFrame, documents: DataFrame, model: FittedBayes, key: str
) -> DataFrame:
    """``documents`` with ``predict`` and the probability of each class. A document
    without known terms is judged by the priors alone."""
    prior = F.array(*[F.lit(p) for p in model.log_prior])
    scored = documents.join(score_bayes(weights, model, key), key, "left").withColumn(
        "scores", F.coalesce("scores", prior)
    )
    top = F.array_max("scores")
    shares = F.transform("scores", lambda s: F.exp(s - top))
    total = F.aggregate(shares, F.lit(0.0), lambda a, s: a + s)
    classes = F.array(*[F.lit(c) for c in model.classes])
    return (
        scored.withColumn("predict", F.element_at(classes, F.array_position("scores", top).cast("int")))
        .withColumn("probability", F.transform(shares, lambda s: s / total))
        .drop("scores")
    )


def term_scores(model: FittedBayes) -> DataFrame:
    """``class, field, term, logp``."""
    return model.terms.select(
        F.posexplode("logp").alias("_i", "logp"), "field", "term"
    ).select(
        F.get(F.array(*[F.lit(c) for c in model.classes]), "_i").alias("class"),
        "field",
        "term",
        "logp",
    )


def top_terms(model: FittedBayes, k: int = 100) -> DataFrame:
    """The ``k`` most probable terms of each class."""
    order = [F.desc("logp"), F.asc("field"), F.asc("term")]
    return top_k_per_group(term_scores(model), ["class"], order, k, ["field", "term"])
