"""Least squares over long-form weights, for vocabularies of any length.

Conjugate gradients on the normal equations, whose matrix is never made: both of its
products are a join and a sum over ``key, field, term, weight``. Coefficients, residuals and
directions are tables of a row a term; the driver sees a few numbers a round. The intercept
is a term of its own that every row has with weight 1, and is not penalized. The diagonal
of the matrix scales the terms, so that columns of unlike size need no more rounds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doctag.operators.lemmas import join_small_or_salted
from doctag.session import durable

INTERCEPT = ""
TERM = ["field", "term"]


@dataclass(frozen=True)
class LeastSquares:
    """``terms``: ``field, term, coefficient, residual``, where the residual is what is left of the
    term's normal equation; the intercept has empty names."""

    terms: DataFrame
    rounds: int


def _with_intercept(weights: DataFrame, rows: DataFrame) -> DataFrame:
    one = rows.select("key", F.lit(INTERCEPT).alias("field"), F.lit(INTERCEPT).alias("term"), F.lit(1.0).alias("weight"))
    return weights.select("key", *TERM, F.col("weight").cast("double")).unionByName(one)


def _times(weights: DataFrame, vector: DataFrame, value: str) -> DataFrame:
    """``key, z``: the weights' rows times a vector of terms."""
    each = join_small_or_salted(weights, vector.select(*TERM, value), TERM, "inner", "key")
    return each.groupBy("key").agg(F.sum(F.col("weight") * F.col(value)).alias("z"))


def _across(weights: DataFrame, rows: DataFrame, value: str) -> DataFrame:
    """``field, term, g``: the weights' columns times a vector of rows."""
    return weights.join(rows, "key").groupBy(*TERM).agg(F.sum(F.col("weight") * F.col(value)).alias("g"))


def fit_least_squares(
    weights: DataFrame, labels: DataFrame, key: str, target: str, penalty: float = 0.0, rounds: int = 100, tolerance: float = 1e-9
) -> LeastSquares:
    """The coefficients with the least sum of squares over ``labels(key, target)``, divided by
    the rows, plus ``penalty`` times their own squares. It ends after ``rounds``, or once the
    residuals, scaled, are a ``tolerance`` of what they were."""
    rows = durable(labels.select(F.col(key).alias("key"), F.col(target).cast("double").alias("y")).filter("y IS NOT NULL"))
    n = rows.count()
    weights = weights.select(F.col(key).alias("key"), *TERM, "weight").join(rows.select("key"), "key", "left_semi")
    weights = durable(_with_intercept(weights, rows))
    ridge = F.when(F.col("field") == INTERCEPT, F.lit(0.0)).otherwise(F.lit(float(penalty) * n))
    sums = weights.join(rows, "key").groupBy(*TERM).agg(
        F.sum(F.col("weight") * F.col("y")).alias("r"), F.sum(F.col("weight") * F.col("weight")).alias("_square")
    )
    scale = F.when(F.col("_square") + ridge > 0, F.col("_square") + ridge).otherwise(F.lit(1.0))
    state = sums.select(*TERM, F.lit(0.0).alias("x"), "r", (F.col("r") / scale).alias("p"), scale.alias("_scale"))
    state = durable(state)

    def dot(a: Column, b: Column) -> Column:
        return F.coalesce(F.sum(a * b), F.lit(0.0))

    z = F.col("r") / F.col("_scale")
    size = first = state.agg(dot(F.col("r"), z)).first()[0]
    done = 0
    while done < rounds and first > 0 and size > tolerance * tolerance * first:
        products = _across(weights, _times(weights, state, "p"), "z")
        # A direction and its product, of which the length of the step follows.
        both = durable(state.join(products, TERM).withColumn("_q", F.col("g") + ridge * F.col("p")))
        curve = both.agg(dot(F.col("p"), F.col("_q"))).first()[0]
        if not curve > 0:
            break
        step = size / curve
        moved = both.select(
            *TERM, (F.col("x") + step * F.col("p")).alias("x"), (F.col("r") - step * F.col("_q")).alias("r"), "p", "_scale"
        )
        moved = durable(moved)
        before, size = size, moved.agg(dot(F.col("r"), z)).first()[0]
        state = moved.withColumn("p", z + (size / before) * F.col("p"))
        done += 1
    # The residual of the equations themselves, not the one that was carried along.
    terms = state.select(*TERM, F.col("x").alias("coefficient"))
    fitted = _times(weights, terms, "coefficient")
    left = rows.join(fitted, "key", "left").select("key", (F.col("y") - F.coalesce("z", F.lit(0.0))).alias("e"))
    residual = (F.col("g") - ridge * F.col("coefficient")) / max(n, 1)
    out = terms.join(_across(weights, left, "e"), TERM).select(*TERM, "coefficient", residual.alias("residual"))
    return LeastSquares(durable(out), done)


def predict_least_squares(weights: DataFrame, documents: DataFrame, model: LeastSquares, key: str, out: str = "score") -> DataFrame:
    """``documents`` with their linear score; one without known terms has the intercept."""
    base = model.terms.filter(F.col("field") == INTERCEPT).agg(F.coalesce(F.first("coefficient"), F.lit(0.0))).first()[0]
    scores = _times(weights.select(F.col(key).alias("key"), *TERM, "weight"), model.terms, "coefficient")
    scores = scores.select(F.col("key").alias(key), (F.col("z") + base).alias(out))
    return documents.join(scores, key, "left").withColumn(out, F.coalesce(out, F.lit(base)))
