"""Classification reports from a confusion table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, label: str = "tag", predict: str = "predict") -> DataFrame:
    """``label, predict, n``; everything else is computed from this small table."""
    return df.groupBy(F.col(label).alias("label"), F.col(predict).alias("predict")).agg(
        F.count(F.lit(1)).alias("n")
    )


def label_report(table: DataFrame) -> DataFrame:
    """``label, precision, recall, f1, support`` for each label that occurs; a
    ratio without a denominator is 0."""
    sides = table.select(
        F.inline(
            F.array(
                F.struct(F.col("label").alias("label"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("said"), F.lit(0).cast("long").alias("hit")),
                F.struct(F.col("predict").alias("label"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("said"), F.when(F.col("label") == F.col("predict"), F.col("n")).otherwise(0).alias("hit")),
            )
        )
    )
    sums = sides.groupBy("label").agg(
        F.sum("actual").alias("support"), F.sum("said").alias("said"), F.sum("hit").alias("hit")
    )

    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(0.0)

    hit, said, support = F.col("hit"), F.col("said"), F.col("support")
    return sums.select(
        "label",
        ratio(hit, said).alias("precision"),
        ratio(hit, support).alias("recall"),
        ratio(2 * hit, said + support).alias("f1"),
        "support",
    )


def report(df: DataFrame, label: str = "tag", predict: str = "predict") -> DataFrame:
    """The label rows and one row ``avg / total`` weighted by support."""
    rows = label_report(confusion(df, label, predict))
    weight = F.sum("support")
    mean = [(F.sum(F.col(c) * F.col("support")) / weight).alias(c) for c in ("precision", "recall", "f1")]
    total = rows.agg(*mean, weight.alias("support")).select(
        F.lit("avg / total").alias("label"), "precision", "recall", "f1", "support"
    )
    return rows.unionByName(total)


def macro_f1(df: DataFrame, label: str = "tag", predict: str = "predict") -> DataFrame:
    """One row: the plain mean of the F1 of all labels."""
    return label_report(confusion(df, label, predict)).agg(F.avg("f1").alias("macro_f1"))


def score_summary(scores: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """Mean and population standard deviation of score columns."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std")]
    return scores.groupBy(*by).agg(*aggs)
