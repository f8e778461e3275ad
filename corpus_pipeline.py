"""The corpus pipeline: each stage reads what its predecessor kept.

    quality classifier -> line dedup -> n-gram Jaccard join -> mixing -> packing

Every stage but the last returns the columns of ``documents``. ``n_chars`` follows the
text where a stage changes it. A stage is written as Parquet below the folder named
by ``spark.checkpoint.dir`` before the next one reads it, so a lost executor never
sends the work back past it. An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doctag.llm import jaccard, lines, mixing, packing, quality
from doctag.llm.registry import Query, durable, table

# No SQL twin: the classifier is trained, and packing depends on a tokenizer.
ORACLE_SQL: str | None = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    # Only what the classifier adds can clash; a column of that name comes back after it.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    judged = quality.score(docs.select("text", row), model)
    return judged.filter("predicted = 1").select("_row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat earlier ones; emptied documents go."""
    left = lines.without_repeats(docs)
    return left.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else left


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies."""
    return jaccard.first_of_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, start, length, doc_tokens, ids, sequence_id, offset``: the pieces of the
    documents with their places in sequences."""
    return packing.pack(packing.token_pieces(docs))


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that the stages keep."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": Query(run, ORACLE_SQL)}
