"""Row numbers, order statistics and top-k without a single-task window.

``key`` columns must identify a row: they replace the row position that a local
data frame has.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from doctag.session import durable

# monotonically_increasing_id keeps the row number in the lower 33 bits.
_ROW_BITS = 33

TOP_K_SALTS = 32
# Pivots of a counting pass, and keys that the driver sorts at most.
PIVOTS, FEW_KEYS = 256, 10_000


def with_row_number(df: DataFrame, order: Sequence[Column], out: str = "rank") -> DataFrame:
    """1-based positions in the global order, computed in parallel: a range
    sort, then each partition adds the sizes of those before it. The sorted rows
    are made durable first, so both reads see the same partitions."""
    place = df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id())
    place = durable(place)
    part = F.shiftright("_place", _ROW_BITS)
    # One row per partition, so this window and the broadcast stay small.
    before = (
        place.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.sum("_n").over(W.orderBy("_part")) - F.col("_n"))
        .select("_part", "_before")
    )
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        place.withColumn("_part", part)
        .join(F.broadcast(before), "_part")
        .withColumn(out, F.col("_before") + row + 1)
        .drop("_part", "_before", "_place")
    )


def key_at(df: DataFrame, key: str, rank: int):
    """The key at a 1-based rank of the order of the keys that are not null; None behind the
    last. A pass counts the keys at and between drawn pivots, and the next one goes on
    between two of them: keys are neither sorted nor stored until few are left, and a
    repeated key ends the search where it holds the rank."""
    rows = df.select(F.col(key).alias("_key")).filter("_key IS NOT NULL")
    while True:
        drawn = rows.orderBy(F.xxhash64("_key")).limit(PIVOTS).collect()
        pivots = sorted({r["_key"] for r in drawn})
        if not pivots:
            return None
        listed = F.array(*[F.lit(p) for p in pivots])
        # Even parts lie between pivots, odd ones are a pivot.
        part = F.size(F.filter(listed, lambda p: p < F.col("_key"))) + F.size(F.filter(listed, lambda p: p <= F.col("_key")))
        counts = dict(rows.groupBy(part.alias("part")).count().collect())
        at = 0
        while at <= 2 * len(pivots) and rank > counts.get(at, 0):
            rank -= counts.get(at, 0)
            at += 1
        if at > 2 * len(pivots):
            return None
        if at % 2:
            return pivots[at // 2]
        if at > 0:
            rows = rows.filter(F.col("_key") > F.lit(pivots[at // 2 - 1]))
        if at < 2 * len(pivots):
            rows = rows.filter(F.col("_key") < F.lit(pivots[at // 2]))
        if counts[at] <= FEW_KEYS:
            return sorted(r["_key"] for r in rows.collect())[rank - 1]


def top_k_per_group(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column],
    k: int,
    spread_by: Sequence[str],
    out: str = "rank",
) -> DataFrame:
    """The first ``k`` rows of each group. A large group is cut into salted
    parts by the ``spread_by`` columns, each part keeps its own first k, and
    only those are ranked together."""
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(TOP_K_SALTS))
    parts = W.partitionBy(*groups, "_salt").orderBy(*order)
    whole = W.partitionBy(*groups).orderBy(*order)
    firsts = (
        df.withColumn("_salt", salt)
        .withColumn("_r", F.row_number().over(parts))
        .filter(F.col("_r") <= k)
        .drop("_r", "_salt")
    )
    return firsts.withColumn(out, F.row_number().over(whole)).filter(F.col(out) <= k)


def draw_order(key: str, seed: int | str) -> Column:
    """A reproducible random order of the keys: rows sorted by this hex digest."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def cut_table(
    df: DataFrame,
    draw: Column,
    ranks: Callable[[Column], Sequence[Column]],
    group: Column | None = None,
) -> DataFrame:
    """``group, cuts``: for each group the draw values at the given ranks.

    ``ranks`` maps the group's row count to 1-based ranks (clipped to the count;
    a rank below 1 gives ``''``). A row is among the first r exactly when its
    draw is at most the cut of r, so callers select with a plain filter and never
    shuffle whole rows. Draws are counted by their first four hex digits, and
    only the few buckets that hold a cut are sorted.
    """
    group = F.lit(0) if group is None else group
    draws = df.select(group.alias("group"), draw.alias("_draw")).withColumn(
        "_bucket", F.substring("_draw", 1, 4)
    )
    by_group = W.partitionBy("group")
    upto = by_group.orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0)
    # At most 65,536 rows per group.
    buckets = (
        draws.groupBy("group", "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_total", F.sum("_n").over(by_group))
        .withColumn("_before", F.sum("_n").over(upto) - F.col("_n"))
        .withColumn("_last", F.col("_before") + F.col("_n"))
    )
    clipped = [F.least(r.cast("long"), F.col("_total")) for r in ranks(F.col("_total"))]
    wanted = (
        buckets.select("*", F.posexplode(F.array(*clipped)).alias("_j", "_rank"))
        .filter((F.col("_rank") > F.col("_before")) & (F.col("_rank") <= F.col("_last")))
        .select("group", "_bucket", "_j", (F.col("_rank") - F.col("_before")).alias("_at"))
    )
    # Only the buckets that hold a cut are sorted; draws spread rows evenly over
    # the buckets, so each is a small share of its group.
    needed = wanted.select("group", "_bucket").distinct()
    at = F.row_number().over(W.partitionBy("group", "_bucket").orderBy("_draw"))
    found = _same_bucket(draws, needed, "left_semi").withColumn("_at", at)
    cuts = _same_bucket(found, wanted, "inner", F.col("l._at") == F.col("r._at")).select(
        F.col("l.group").alias("group"), F.struct("r._j", "l._draw").alias("_cut")
    )
    n = len(clipped)
    return (
        cuts.groupBy("group")
        .agg(F.map_from_entries(F.collect_list("_cut")).alias("_cuts"))
        .select(
            "group",
            F.transform(
                F.sequence(F.lit(0), F.lit(n - 1)),
                lambda j: F.coalesce(F.element_at("_cuts", j), F.lit("")),
            ).alias("cuts"),
        )
    )


def _same_bucket(left: DataFrame, right: DataFrame, how: str, also: Column | None = None):
    same = F.col("l.group").eqNullSafe(F.col("r.group")) & (
        F.col("l._bucket") == F.col("r._bucket")
    )
    on = same if also is None else same & also
    return left.alias("l").join(right.alias("r"), on, how)


def cut_at(df: DataFrame, draw: Column, rank: int | Callable[[Column], Column]) -> str:
    """The draw value at one rank of the whole set; ``''`` when there is none."""
    ranks = rank if callable(rank) else lambda n: F.lit(rank)
    row = cut_table(df, draw, lambda n: [ranks(n)]).first()
    return row.cuts[0] if row else ""
