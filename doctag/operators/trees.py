"""A decision tree over long-form weights, for vocabularies of any length.

The tree grows level by level. A document is one row with its terms; where it stands in the
tree follows from the splits of the levels above, which are sent along, so no level moves a
document. The terms are counted by node, term, class and step of weight in one aggregate.
A term that a document lacks weighs nothing: the documents without it are those of
the node less those that were counted.

Weights are cut at multiples of 1 / ``STEPS``; the weights of a field have unit length, so
none is above 1. A split sends the documents above its cut to the right. It is the one with
the largest decrease of the Gini impurity; ties go to the smaller field, term and step. Node
``n`` has the children ``2 n`` and ``2 n + 1``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from doctag.session import durable

STEPS = 32
#: Nodes of a level that are sent along; their number is checked.
BROADCAST_NODES = 1_000_000
# Digits that gains are compared on.
DIGITS = 12


@dataclass(frozen=True)
class Tree:
    """``nodes``: ``node, counts, gain, field, term, step``; a leaf has no term. A document goes
    to the right where the step of its weight is ``step`` at least."""

    classes: tuple[str, ...]
    nodes: DataFrame
    depth: int


def weight_step(weight: Column) -> Column:
    """The number of the interval that a weight lies in; each holds its upper end."""
    return F.ceil(F.round(weight * STEPS, 6)).cast("int")


def term_rows(weights: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """``documents`` with ``terms``, an array of ``field, term, step``."""
    terms = F.collect_list(F.struct("field", "term", weight_step(F.col("weight")).alias("step")))
    own = weights.filter("weight > 0").groupBy(key).agg(terms.alias("terms"))
    none = F.array().cast("array<struct<field:string,term:string,step:int>>")
    return documents.join(own, key, "left").withColumn("terms", F.coalesce("terms", none))


def _sent(side: DataFrame) -> DataFrame:
    return F.broadcast(side) if side.count() <= BROADCAST_NODES else side


def _routed(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """One level further down; documents whose node has no split stay."""
    split = splits.filter("term IS NOT NULL").select("node", *[F.col(c).alias(f"_{c}") for c in ("field", "term", "step")])
    above = F.exists(
        "terms", lambda t: (t["field"] == F.col("_field")) & (t["term"] == F.col("_term")) & (t["step"] >= F.col("_step"))
    )
    node = F.when(F.col("_term").isNull(), F.col("node")).otherwise(2 * F.col("node") + above.cast("long"))
    out = rows.join(_sent(split), "node", "left")
    return out.withColumn("node", node).select(*rows.columns)


def _squares(counts: Sequence[Column]) -> Column:
    """The sum of the squared counts over their sum."""
    total = reduce(Column.__add__, counts)
    return reduce(Column.__add__, [c * c for c in counts]) / F.nullif(total, F.lit(0))


def fit_tree(rows: DataFrame, label: str, classes: Sequence[str], depth: int = 30) -> Tree:
    """A tree over ``rows(terms, label)``; rows with another label, or none, are not used."""
    labelled = rows.filter(F.col(label).isin(list(classes))).select(
        (F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)) - 1).alias("cls"),
        "terms",
        F.lit(1).cast("long").alias("node"),
    )
    routed, levels = durable(labelled), []
    names = [f"c{i}" for i in range(len(classes))]
    counted = [F.count_if(F.col("cls") == i).alias(n) for i, n in enumerate(names)]
    for level in range(depth + 1):
        here = routed.filter(F.col("node") >= 2**level)
        totals = durable(here.groupBy("node").agg(*counted))
        if totals.isEmpty():
            break
        counts = F.array(*names).alias("counts")
        if level == depth:
            levels.append(totals.select("node", counts))
            break
        seen = here.select("node", "cls", F.inline("terms")).groupBy("node", "field", "term", "step").agg(*counted)
        # At most STEPS rows a term; from the top, so that a sum holds what lies above a cut.
        above = W.partitionBy("node", "field", "term").orderBy(F.desc("step")).rowsBetween(W.unboundedPreceding, 0)
        right = seen.select("node", "field", "term", "step", *[F.sum(n).over(above).alias(f"r{n}") for n in names])
        both = right.join(_sent(totals), "node")
        rights, lefts = [F.col(f"r{n}") for n in names], [F.col(n) - F.col(f"r{n}") for n in names]
        n = reduce(Column.__add__, [F.col(c) for c in names])
        gain = F.round((_squares(rights) + _squares(lefts) - _squares([F.col(c) for c in names])) / n, DIGITS)
        best = (
            both.select("node", "field", "term", "step", gain.alias("gain"))
            .filter("gain > 0")
            .groupBy("node")
            .agg(F.min(F.struct((-F.col("gain")).alias("_less"), "field", "term", "step")).alias("_best"))
        )
        splits = durable(
            totals.join(best, "node", "left").select(
                "node", counts, (-F.col("_best._less")).alias("gain"), "_best.field", "_best.term", "_best.step"
            )
        )
        levels.append(splits)
        if splits.filter("term IS NOT NULL").isEmpty():
            break
        routed = _routed(routed, splits)
    kind = "node long, counts array<long>, gain double, field string, term string, step int"
    none = rows.sparkSession.createDataFrame([], kind)
    nodes = durable(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), levels, none))
    return Tree(tuple(classes), nodes, depth)


def predict_tree(rows: DataFrame, tree: Tree, out: str = "predict") -> DataFrame:
    """``rows`` with the most frequent class of their leaf, the first of equals, in place of
    ``terms``."""
    routed = rows.withColumn("node", F.lit(1).cast("long"))
    deepest = tree.nodes.filter("term IS NOT NULL").agg(F.max("node")).first()[0] or 0
    for level in range(int(deepest).bit_length()):
        routed = _routed(routed, tree.nodes.filter((F.col("node") >= 2**level) & (F.col("node") < 2 ** (level + 1))))
    name = F.get(F.array(*[F.lit(c) for c in tree.classes]), (F.array_position("counts", F.array_max("counts")) - 1).cast("int"))
    leaves = tree.nodes.select("node", name.alias(out))
    return routed.drop(out).join(_sent(leaves), "node", "left").drop("node", "terms")


def save_tree(tree: Tree, path: str) -> None:
    spark = tree.nodes.sparkSession
    about = [(list(tree.classes), tree.depth)]
    spark.createDataFrame(about, "classes array<string>, depth int").write.parquet(f"{path}/about")
    tree.nodes.write.parquet(f"{path}/nodes")


def load_tree(spark: SparkSession, path: str) -> Tree:
    about = spark.read.parquet(f"{path}/about").first()
    return Tree(tuple(about.classes), spark.read.parquet(f"{path}/nodes"), about.depth)
