"""Mixing sources to target weights.

Words are summed per source; a source's target is its weight's share of all
words, but at most ``cap`` times its own size, and what is cut off goes to the
others by weight. A document of a source with repetition rate r = target / size
is emitted floor(r) times, and once more if its hash-seeded coin falls below the
fraction of r.

Defined cases: null text has size 0; a null source is a source of its own, after
all others; a source of size 0 has target 0 and emits nothing; documents without
words of other sources are repeated like any other; repeated rows toss the same
coin; a null document id tosses the coin of its text; an empty table gives an
empty mix. Other columns pass through ``mix`` untouched, whatever their names:
working columns are renamed away from them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from doctag.llm.registry import durable, query, table
from doctag.operators.order import with_row_number

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
CAP = 3
# Hex digits of the coin: 52 bits, which a double holds exactly.
COIN_DIGITS = 13


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def coin(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) that only depends on the seed and the document."""
    key = F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit(""))))
    digest = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, COIN_DIGITS)
    return F.conv(digest, 16, 10).cast("double") / F.lit(float(16**COIN_DIGITS))


def source_targets(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP
) -> DataFrame:
    """``source, source_size, target`` of ``sized(source, size)``.

    Everything stays a table with a row per source. Sources over their cap are
    found in rounds: each round spreads what is left over the sources that were
    not above in the last one, until no more are above. The level only rises, so
    there are at most as many rounds as sources, in practice a few."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_row_number(totals, [F.col("source").asc_nulls_last()], "_rank")
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]),
        (F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    sources = durable(ranked.select("source", "source_size", weight.cast("long").alias("_w")))
    level, above = 0.0, -1
    while True:
        over = F.lit(level) * F.col("_w") > F.lit(float(cap)) * F.col("source_size")
        row = sources.agg(
            F.sum("source_size"),
            F.sum(F.when(over, F.col("source_size")).otherwise(0)),
            F.sum(F.when(over, 0).otherwise(F.col("_w"))),
            F.count(F.when(over, 1)),
        ).first()
        if not row[0] or not row[2] or row[3] == above:
            break
        above = row[3]
        level = float(row[0] - cap * row[1]) / float(row[2])
    target = F.least(F.lit(level) * F.col("_w"), F.lit(float(cap)) * F.col("source_size"))
    return sources.select("source", "source_size", target.alias("target"))


def _planned(sized: DataFrame, targets: DataFrame, draw: Column) -> DataFrame:
    """Adds ``source_size, target, copies`` to rows with ``source``. The targets
    are a stored table of a row per source: Spark broadcasts it below its own
    threshold and otherwise joins by source, splitting a hot one."""
    to = targets.select(
        F.col("source").alias("_to"), F.col("source_size"), F.col("target")
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    copies = F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)
    return (
        sized.join(to, sized["source"].eqNullSafe(to["_to"]))
        .drop("_to")
        .withColumn("copies", copies.cast("long"))
    )


def mix_plan(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, seed: str = "mix"
) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies`` of
    ``docs(doc_id, text, source)``, one row per row. The texts are read once."""
    sized = durable(
        docs.select(
            "doc_id",
            "source",
            word_count(F.col("text")).alias("size"),
            coin(F.col("doc_id"), F.col("text"), seed).alias("_coin"),
        )
    )
    return _planned(sized, source_targets(sized, weights, cap), F.col("_coin")).drop("_coin")


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, seed: str = "mix"
) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as the plan says, with the
    columns of ``docs``. Texts are never shuffled while the table of sources can
    be broadcast."""
    sized = docs.select("source", word_count(F.col("text")).alias("size"))
    targets = source_targets(sized, weights, cap)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(
        F.col("source"), whole.alias("_row"), coin(F.col("doc_id"), F.col("text"), seed).alias("_coin")
    )
    return (
        _planned(rows, targets, F.col("_coin"))
        .filter(F.col("copies") > 0)
        .select("_row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select("_row.*")
    )


SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 13))::BIGINT::DOUBLE
           / 4503599627370496.0::DOUBLE AS coin
  FROM documents),
totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS w
  FROM sized GROUP BY source),
filling AS (
  SELECT *, coalesce(sum(source_size) OVER before, 0)::BIGINT AS full_size,
         (sum(w) OVER ())::BIGINT - coalesce(sum(w) OVER before, 0)::BIGINT AS rest_w,
         (sum(source_size) OVER ())::BIGINT AS all_size
  FROM totals
  WINDOW before AS (ORDER BY source_size::DOUBLE / w, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT max((all_size - 3 * full_size)::DOUBLE / rest_w::DOUBLE) AS level FROM filling
  WHERE (all_size - 3 * full_size)::DOUBLE / rest_w::DOUBLE * w <= 3.0::DOUBLE * source_size),
targets AS (
  SELECT source, source_size, least(coalesce(level, 0) * w, 3.0::DOUBLE * source_size) AS target
  FROM totals, level),
rates AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, s.coin,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       size * (floor(rate)::BIGINT + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END) AS taken
FROM rates
"""


@query("op3_mixing", SQL)
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes from it."""
    plan = mix_plan(table(spark, sf_dir, "documents"))
    return plan.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )
