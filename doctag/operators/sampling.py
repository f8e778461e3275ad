"""Exact, reproducible samples, splits and folds.

The random order of a seed is the order of ``draw_order(key, seed)``, so the same
rows are drawn whatever the partitioning and after any retry. All selections end
in a filter on that digest; see :func:`doctag.operators.order.cut_table`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doctag.operators.dataset import one_vs_rest
from doctag.operators.order import cut_at, cut_table, draw_order, with_row_number

ALL = "ALL"
# Cut tables up to this many groups are sent along with the tasks.
BROADCAST_GROUPS = 10_000


def sample_exact(df: DataFrame, key: str, n: int, seed: int | str = 0) -> DataFrame:
    """``n`` rows without replacement, or all rows when there are fewer."""
    draw = draw_order(key, seed)
    return df.filter(draw <= cut_at(df, draw, n))


def sample_fraction(df: DataFrame, key: str, fraction: float, seed: int | str = 0) -> DataFrame:
    """``int(rows * fraction)`` rows of ``df``."""
    draw = draw_order(key, seed)
    return df.filter(draw <= cut_at(df, draw, lambda n: F.floor(n * F.lit(fraction))))


def sample(
    df: DataFrame,
    key: str,
    size: int | float | str = ALL,
    seed: int | str = 0,
    repeated: bool = False,
    ledger: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """A sample and the ledger of drawn keys with the sample added.

    A fraction counts from the whole set, and the sample is no larger than what
    is left to draw from. ``repeated`` draws from the whole set; otherwise keys in
    the ledger, or rows marked ``sampled``, are left out (no mark is not a mark). ``'ALL'`` is the entire
    set, drawn or not.
    """
    if size == ALL:
        return df, ledger
    source = df
    if not repeated:
        if "sampled" in df.columns:
            source = source.filter(~F.coalesce("sampled", F.lit(False)))
        if ledger is not None:
            source = exclude_sampled(source, ledger, key)
    n = int(df.count() * size) if isinstance(size, float) else size
    drawn = sample_exact(source, key, n, seed)
    if ledger is None:
        return drawn, None
    return drawn, ledger.select(key).unionByName(drawn.select(key)).distinct()


def exclude_sampled(df: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    return df.join(ledger.select(key), key, "left_anti")


def mark_sampled(df: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """Set ``sampled`` on the rows whose key is in the ledger."""
    drawn = ledger.select(key).distinct().withColumn("_drawn", F.lit(True))
    old = F.col("sampled") if "sampled" in df.columns else F.lit(False)
    return (
        df.join(drawn, key, "left")
        .withColumn("sampled", F.coalesce("_drawn", old))
        .drop("_drawn")
    )


def training_set(
    df: DataFrame, label: str, key: str, seed: int | str = 0, relabel: bool = True
) -> DataFrame:
    """As many rows tagged ``label`` as rows with another tag: the larger side is
    sampled down to the smaller, the labelled side when they are equal. With
    ``relabel`` the others are tagged ``!label``."""
    target = F.col("tag").eqNullSafe(F.lit(label))
    n_target, n_all = df.agg(F.count_if(target), F.count(F.lit(1))).first()
    n_rest = n_all - n_target
    thin_target = n_target >= n_rest
    thinned = target if thin_target else ~target
    draw = draw_order(key, seed)
    cut = cut_at(df.filter(thinned), draw, min(n_target, n_rest))
    out = df.filter(~thinned | (draw <= cut))
    return one_vs_rest(out, label) if relabel else out


def shuffle(df: DataFrame, key: str, seed: int | str = 0, position: str | None = None) -> DataFrame:
    """Rows in the random order of the seed; ``position`` names a column for the place."""
    if position:
        return with_row_number(df, [draw_order(key, seed)], position)
    return df.orderBy(draw_order(key, seed))


def split_exact(
    df: DataFrame, key: str, test: float = 0.3, seed: int | str = 0
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; the test side has ``ceil(rows * test)``."""
    draw = draw_order(key, seed)
    cut = cut_at(df, draw, lambda n: F.ceil(n * F.lit(test)))
    return df.filter(draw > cut), df.filter(draw <= cut)


def stratified_folds(
    df: DataFrame, key: str, label: str, k: int, seed: int | str = 0, out: str = "fold"
) -> DataFrame:
    """Fold numbers ``0..k-1`` such that the rows of each label are divided as
    evenly as possible: the draws of a label are cut into k runs."""
    if k < 2:
        return df.withColumn(out, F.lit(0))
    draw = draw_order(key, seed)
    table = cut_table(
        df, draw, lambda n: [F.floor(n * j / k) for j in range(1, k)], F.col(label)
    )
    rows = table.limit(BROADCAST_GROUPS + 1).collect()
    if len(rows) <= BROADCAST_GROUPS:
        table = F.broadcast(df.sparkSession.createDataFrame(rows, table.schema))
    fold = F.size(F.filter("_cuts", lambda cut: draw > cut))
    cuts = table.select(F.col("group").alias("_group"), F.col("cuts").alias("_cuts"))
    return (
        df.join(cuts, F.col(label).eqNullSafe(F.col("_group")), "left")
        .withColumn(out, fold)
        .drop("_group", "_cuts")
    )


def shuffle_splits(
    df: DataFrame, key: str, n_splits: int, test: float = 0.2, seed: int = 0
) -> DataFrame:
    """``split, key, is_test`` for independent splits; split i uses the draws of
    seed + i. All cuts come from one pass over the keys."""
    splits = df.select(
        key, F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))).alias("split")
    ).withColumn(
        "_draw",
        F.md5(F.concat((F.col("split") + seed).cast("string"), F.lit(":"), F.col(key).cast("string"))),
    )
    cuts = cut_table(splits, F.col("_draw"), lambda n: [F.ceil(n * F.lit(test))], F.col("split"))
    found = {r.group: r.cuts[0] for r in cuts.collect()}
    cut = F.array(*[F.lit(found.get(i, "")) for i in range(n_splits)])
    return splits.select("split", key, (F.col("_draw") <= F.get(cut, "split")).alias("is_test"))
