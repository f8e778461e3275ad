"""Document set operators: filters, columns, unions, reviews."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doctag.functions.tokens import TokenOptions, token_record, token_text, tokenize, with_ngrams
from doctag.operators.order import key_at, with_row_number
from doctag.session import durable

DESC_MIN_CHARS = 60
PRE_PROCESS_NGRAM = 5
NOT_SURE = "not sure"


def title_contains(df: DataFrame, words: Sequence[str], col: str = "title") -> DataFrame:
    """Rows whose title contains any of the literal words; case-sensitive."""
    if not words:
        return df
    return df.filter(reduce(or_, [F.col(col).contains(w) for w in words]))


def min_length(df: DataFrame, col: str = "desc", n: int = DESC_MIN_CHARS) -> DataFrame:
    """Rows with more than ``n`` characters in ``col``."""
    return df.filter(F.length(col) > n)


def by_label(df: DataFrame, value: str | None = None, col: str = "predict") -> DataFrame:
    """Rows with the given label; no value means no filter."""
    return df if value is None else df.filter(F.col(col) == value)


def slice_rows(
    df: DataFrame, key: str, begin: int | None = None, end: int | None = None
) -> DataFrame:
    """Rows ``[begin, end)`` of the key order, both ends optional and counted from
    the end when negative. The key column is stored once, the keys at the two ends are
    found by counting, and the rows are then taken by a key range that reaches the scan.
    Null keys come first. A repeated key, null included, is not divided: all of its rows
    are taken if one of them lies in the slice."""
    if begin is None and end is None:
        return df
    keys = durable(df.select(key))
    if (begin or 0) < 0 or (end or 0) < 0:
        total = keys.count()
        begin = max(total + begin, 0) if begin is not None and begin < 0 else begin
        end = max(total + end, 0) if end is not None and end < 0 else end
    first = (begin or 0) + 1
    if end is not None and end < first:
        return df.filter(F.lit(False))
    nulls = keys.filter(F.col(key).isNull()).count()
    if end is not None and end <= nulls:
        return df.filter(F.col(key).isNull())
    low = key_at(keys, key, max(first - nulls, 1))
    # An end behind the last row is no bound.
    high = None if end is None else key_at(keys, key, end - nulls)
    inside = F.lit(False) if low is None else F.col(key) >= low
    inside = inside if high is None else inside & (F.col(key) <= high)
    return df.filter(inside | F.col(key).isNull() if first <= nulls else inside)


def renumber(df: DataFrame, key: str, out: str = "row") -> DataFrame:
    """Dense 0-based row numbers in key order."""
    return with_row_number(df, [F.col(key)], out).withColumn(out, F.col(out) - 1)


def head(df: DataFrame, key: str, n: int = 4) -> DataFrame:
    return df.orderBy(key).limit(n)


def mispredicted(df: DataFrame, label: str = "tag", predict: str = "predict") -> DataFrame:
    return df.filter(~F.col(label).eqNullSafe(F.col(predict)))


def not_sampled(df: DataFrame) -> DataFrame:
    """Rows that are not marked; a row without a mark was never drawn."""
    return df.filter(~F.coalesce("sampled", F.lit(False)))


def add_columns(
    df: DataFrame,
    exprs: Mapping[str, Column] | None = None,
    other: DataFrame | None = None,
    key: str | None = None,
) -> DataFrame:
    """New columns in name order, from expressions or by key from another frame."""
    if exprs:
        df = df.withColumns({name: exprs[name] for name in sorted(exprs)})
    if other is not None:
        if key is None:
            raise ValueError("columns of another frame need a key")
        names = sorted(c for c in other.columns if c != key)
        keep = df.drop(*names)
        df = keep.join(other.select(key, *names), key, "left").select(*keep.columns, *names)
    return df


def one_vs_rest(df: DataFrame, label: str, col: str = "tag") -> DataFrame:
    """Every other tag becomes ``!label``."""
    is_label = F.col(col).eqNullSafe(F.lit(label))
    return df.withColumn(col, F.when(is_label, F.col(col)).otherwise(F.lit("!" + label)))


# Stands between the parts of what an id is made from.
ID_SEPARATOR = "\x1f"


def document_id(salt: str, key: str | None = None) -> Column:
    """The id of a document in the batch named ``salt``. Copies get ids of their own:
    from the ``key`` of the row, or without one from its place in the plan, which a
    later run need not repeat."""
    row = F.monotonically_increasing_id() if key is None else F.col(key)
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (row, F.col("title"), F.col("desc"))]
    return F.md5(F.concat_ws(ID_SEPARATOR, F.lit(salt), *parts))


def preprocess(
    df: DataFrame,
    options: TokenOptions = TokenOptions(ngram=PRE_PROCESS_NGRAM),
    salt: str = "",
    key: str | None = None,
) -> DataFrame:
    """A document set from raw documents: id, token texts and the sampled mark. The token
    texts' columns record the options, in snapshots too. Other columns are kept in front; ``key`` names the one that the ids come from."""
    own = ("job_id", "title", "desc", "tag", "title_seg", "desc_seg", "sampled")
    record = {"tokens": token_record(options)}
    return df.select(
        *[c for c in df.columns if c not in own],
        document_id(salt, key).alias("job_id"),
        "title",
        "desc",
        "tag",
        token_text(tokenize(F.col("title"), options)).alias("title_seg", metadata=record),
        token_text(tokenize(F.col("desc"), options)).alias("desc_seg", metadata=record),
        F.lit(False).alias("sampled"),
    )


def reinit(
    df: DataFrame,
    options: TokenOptions = TokenOptions(ngram=PRE_PROCESS_NGRAM),
    salt: str = "",
    min_chars: int = DESC_MIN_CHARS,
    keep: Sequence[str] = (),
    key: str | None = None,
) -> DataFrame:
    """Drop short documents and user columns, derive everything else anew."""
    raw = df.select(*keep, "title", "desc", "tag")
    return preprocess(min_length(raw, "desc", min_chars), options, salt, key)


def tokenize_documents(
    df: DataFrame,
    title_ngram: int = 5,
    desc_ngram: int = 4,
    options: TokenOptions = TokenOptions(),
    words_of: Callable[[str], Column] | None = None,
) -> DataFrame:
    """Add the token texts ``title_seg`` and ``desc_seg``. Words that were made before with
    these options are given by ``words_of``, a function of ``title`` and ``desc``."""
    from dataclasses import replace

    def seg(col, n):
        if words_of is not None:
            return token_text(with_ngrams(words_of(col), n))
        return token_text(tokenize(F.col(col), replace(options, ngram=n)))

    out = df.withColumns(
        {"title_seg": seg("title", title_ngram), "desc_seg": seg("desc", desc_ngram)}
    )
    for col, n in (("title_seg", title_ngram), ("desc_seg", desc_ngram)):
        out = out.withMetadata(col, {"tokens": token_record(replace(options, ngram=n))})
    return out


def apply_decisions(
    df: DataFrame, decisions: DataFrame, key: str, default: str, pos: str, neg: str
) -> tuple[DataFrame, DataFrame]:
    """Review codes as tags: ``''`` default, ``'+'`` positive, ``'-'`` negative,
    ``'.'`` not sure. Rows without a decision keep their tag; decisions with any
    other code are returned as the second frame."""
    code = F.col("_code")
    joined = df.join(decisions.select(key, F.col("code").alias("_code")), key, "left")
    tag = (
        F.when(code == "", default)
        .when(code == "-", neg)
        .when(code == "+", pos)
        .when(code == ".", NOT_SURE)
        .otherwise(F.col("tag"))
    )
    tagged = joined.withColumn("tag", tag).select(*df.columns)
    rejected = decisions.filter(~F.col("code").isin("", "-", "+", "."))
    return tagged, rejected


def append(df: DataFrame, others: DataFrame | Sequence[DataFrame]) -> DataFrame:
    """One or more document sets behind ``df``. Columns they lack become null,
    columns that ``df`` lacks are an error."""
    if isinstance(others, DataFrame):
        others = [others]
    if not isinstance(others, (list, tuple)):
        raise TypeError("append takes a DataFrame or a list of DataFrames")
    for n, other in enumerate(others):
        if not isinstance(other, DataFrame):
            raise TypeError(f"item {n} is not a DataFrame")
        foreign = set(other.columns) - set(df.columns)
        if foreign:
            raise ValueError(f"item {n} has foreign columns {sorted(foreign)}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), others, df)


def non_null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of values in each column."""
    return df.agg(*[F.count(c).alias(c) for c in df.columns])


def label_counts(df: DataFrame, col: str = "tag") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("documents"))
