"""Samples, balanced training sets, splits and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from doctag.operators import sampling as S
from doctag.plans.catalog.registry import DOCS, LABELLED, labelled_docs, query, table, with_


def draw(seed, key: str = "doc_id") -> str:
    return f"md5('{seed}:' || CAST({key} AS VARCHAR))"


def keys(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", "n_chars")


@query("sample_of_n", "W6", f"SELECT doc_id, lang, n_chars FROM documents ORDER BY {draw(7)} LIMIT 123")
def sample_of_n(spark, sf):
    return S.sample_exact(keys(spark, sf), "doc_id", 123, 7)


@query(
    "sample_of_a_third",
    "W6 W7",
    f"SELECT doc_id, lang, n_chars FROM documents ORDER BY {draw(8)} LIMIT (SELECT CAST(floor(count(*) * CAST(0.33 AS DOUBLE)) AS BIGINT) FROM documents)",
)
def sample_of_a_third(spark, sf):
    return S.sample_fraction(keys(spark, sf), "doc_id", 0.33, 8)


@query("sample_of_all", "W8", "SELECT doc_id, lang, n_chars FROM documents")
def sample_of_all(spark, sf):
    return S.sample(keys(spark, sf), "doc_id")[0]


LEFT = "remaining AS (SELECT * FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))"


@query(
    "sample_without_drawn",
    "W9 F8 J5",
    with_(
        LEFT,
        select=f"SELECT doc_id, lang, n_chars FROM remaining ORDER BY {draw(3)} LIMIT 77",
    ),
)
def sample_without_drawn(spark, sf):
    drawn = table(spark, sf, "labels").select("doc_id")
    return S.sample(keys(spark, sf), "doc_id", 77, 3, ledger=drawn)[0]


@query(
    "sample_fraction_without_drawn",
    "W7 W9",
    with_(
        LEFT,
        select=f"SELECT doc_id, lang, n_chars FROM remaining ORDER BY {draw(4)}"
        " LIMIT (SELECT least(CAST(floor(count(*) * CAST(0.9 AS DOUBLE)) AS BIGINT), (SELECT count(*) FROM remaining)) FROM documents)",
    ),
)
def sample_fraction_without_drawn(spark, sf):
    drawn = table(spark, sf, "labels").select("doc_id")
    return S.sample(keys(spark, sf), "doc_id", 0.9, 4, ledger=drawn)[0]


@query(
    "sample_of_marked",
    "W9 F8",
    "SELECT doc_id, sampled FROM (SELECT doc_id, CASE WHEN toxic = 1 THEN NULL ELSE quality = 0 END AS sampled"
    f" FROM labels) WHERE sampled IS NOT TRUE ORDER BY {draw(5)} LIMIT 30",
)
def sample_of_marked(spark, sf):
    """Rows without a mark can be drawn, as rows that were appended have none."""
    mark = F.when(F.col("toxic") == 1, None).otherwise(F.col("quality") == 0)
    marked = table(spark, sf, "labels").select("doc_id", mark.alias("sampled"))
    return S.sample(marked, "doc_id", 30, 5)[0]


@query(
    "sample_ledger",
    "W9 J6",
    with_(
        LEFT,
        f"picked AS (SELECT doc_id FROM remaining ORDER BY {draw(3)} LIMIT 77)",
        select="SELECT doc_id FROM labels UNION SELECT doc_id FROM picked",
    ),
)
def sample_ledger(spark, sf):
    drawn = table(spark, sf, "labels").select("doc_id")
    return S.sample(keys(spark, sf), "doc_id", 77, 3, ledger=drawn)[1]


@query(
    "sample_repeated",
    "W9",
    f"SELECT doc_id, lang, n_chars FROM documents ORDER BY {draw(5)} LIMIT 88",
)
def sample_repeated(spark, sf):
    drawn = table(spark, sf, "labels").select("doc_id")
    return S.sample(keys(spark, sf), "doc_id", 88, 5, repeated=True, ledger=drawn)[0]


def balanced_sql(label: str, tag: str) -> str:
    return with_(
        DOCS,
        LABELLED,
        f"sides AS (SELECT *, tag = '{label}' AS target, count(*) OVER (PARTITION BY tag = '{label}') AS n,"
        f" count(*) OVER () AS total, row_number() OVER (PARTITION BY tag = '{label}' ORDER BY {draw(11)}) AS r FROM labelled)",
        select=f"SELECT doc_id, {tag} AS tag FROM sides WHERE r <= least(n, total - n)",
    )


@query("training_set", "W10 U4", balanced_sql("1", "CASE WHEN target THEN tag ELSE '!1' END"))
def training_set(spark, sf):
    return S.training_set(labelled_docs(spark, sf), "1", "doc_id", 11).select("doc_id", "tag")


@query("training_set_rare_label", "W10", balanced_sql("0", "tag"))
def training_set_rare_label(spark, sf):
    out = S.training_set(labelled_docs(spark, sf), "0", "doc_id", 11, relabel=False)
    return out.select("doc_id", "tag")


@query(
    "shuffled_rows",
    "W11",
    f"SELECT doc_id, lang, n_chars, row_number() OVER (ORDER BY {draw(1)}) AS position FROM documents",
)
def shuffled_rows(spark, sf):
    return S.shuffle(keys(spark, sf), "doc_id", 1, "position")


SPLIT = (
    f"ranked AS (SELECT doc_id, row_number() OVER (ORDER BY {draw(21)}) AS r, count(*) OVER () AS n FROM documents)"
)


@query(
    "train_test_split",
    "W12",
    with_(
        SPLIT,
        select="SELECT doc_id, CASE WHEN r <= ceil(n * CAST(0.3 AS DOUBLE)) THEN 'test' ELSE 'train' END AS side FROM ranked",
    ),
)
def train_test_split(spark, sf):
    train, test = S.split_exact(keys(spark, sf).select("doc_id"), "doc_id", 0.3, 21)
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


@query(
    "stratified_folds",
    "W13",
    f"""WITH ranked AS (
  SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {draw(31)}) AS r,
         count(*) OVER (PARTITION BY quality) AS n
  FROM labels)
SELECT doc_id, quality,
  (CASE WHEN r > floor(n * 1 / CAST(6 AS DOUBLE)) THEN 1 ELSE 0 END) + (CASE WHEN r > floor(n * 2 / CAST(6 AS DOUBLE)) THEN 1 ELSE 0 END)
  + (CASE WHEN r > floor(n * 3 / CAST(6 AS DOUBLE)) THEN 1 ELSE 0 END) + (CASE WHEN r > floor(n * 4 / CAST(6 AS DOUBLE)) THEN 1 ELSE 0 END)
  + (CASE WHEN r > floor(n * 5 / CAST(6 AS DOUBLE)) THEN 1 ELSE 0 END) AS fold
FROM ranked""",
)
def stratified_folds(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return S.stratified_folds(labels, "doc_id", "quality", 6, 31)


@query(
    "shuffle_splits",
    "W14",
    """WITH s AS (SELECT doc_id, unnest(range(0, 100)) AS split FROM labels),
r AS (SELECT doc_id, split, row_number() OVER (PARTITION BY split
        ORDER BY md5(CAST(split AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR))) AS r,
        count(*) OVER (PARTITION BY split) AS n FROM s)
SELECT doc_id, CAST(split AS INTEGER) AS split, r <= ceil(n * CAST(0.2 AS DOUBLE)) AS is_test FROM r""",
)
def shuffle_splits(spark, sf):
    return S.shuffle_splits(table(spark, sf, "labels").select("doc_id"), "doc_id", 100, 0.2, 0)
