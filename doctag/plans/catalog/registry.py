"""The registry of catalog queries and what they share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doctag.session import by_key, spread

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    """A query, the survey rows it covers, and its SQL twin where there is one."""

    run: QueryFn
    covers: tuple[str, ...]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register a query under ``name`` for the survey rows in ``covers``."""

    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(fn, tuple(covers.split()), sql)
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str, keyed: bool = False) -> DataFrame:
    """``doc_id, title, desc``: the title is the first line of the text. ``keyed`` rows are hashed
    by their id at every size, for plans that take them apart and group them again."""
    rows = (by_key if keyed else spread)(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return rows.select(
        "doc_id", F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("desc")
    )


def tagged_docs(spark: SparkSession, sf_dir: str, label: str = "quality") -> DataFrame:
    """``docs`` with the label as a string tag, null where there is none."""
    tags = table(spark, sf_dir, "labels").select("doc_id", F.col(label).cast("string").alias("tag"))
    return docs(spark, sf_dir).join(tags, "doc_id", "left")


def labelled_docs(spark: SparkSession, sf_dir: str, label: str = "quality") -> DataFrame:
    tags = table(spark, sf_dir, "labels").select("doc_id", F.col(label).cast("string").alias("tag"))
    return docs(spark, sf_dir).join(tags, "doc_id")


# The fixture texts have no Thai. Six rare letters are turned into Thai ones, so
# that the Thai rules meet real boundaries in every text.
LATIN, THAI_LETTERS = "qjzkwv", "กขคงจฉ"


def thai_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, t``: whole texts with some letters made Thai."""
    rows = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return rows.select("doc_id", F.translate("text", LATIN, THAI_LETTERS).alias("t"))


# --- SQL fragments of the twins -------------------------------------------------

DOCS = "docs AS (SELECT doc_id, split_part(text, chr(10), 1) AS title, text AS body FROM documents)"
TAGGED = (
    "tagged AS (SELECT d.*, CAST(l.quality AS VARCHAR) AS tag"
    " FROM docs d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
)
LABELLED = (
    "labelled AS (SELECT d.*, CAST(l.quality AS VARCHAR) AS tag"
    " FROM docs d JOIN labels l ON d.doc_id = l.doc_id)"
)
THAI_TEXT = (
    f"thai AS (SELECT doc_id, translate(text, '{LATIN}', '{THAI_LETTERS}') AS t FROM documents)"
)



def sql_id(salt: str, of: str = "") -> str:
    """The id of a document in the batch named ``salt``."""
    return f"md5(concat_ws(chr(31), '{salt}', CAST({of}doc_id AS VARCHAR), title, body))"


TH = r"\x{0E00}-\x{0E7F}"
WS = (
    r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
LEGAL_CLASS = r" #+\-.0-9@A-Za-z\x{0E01}-\x{0E3A}\x{0E3F}-\x{0E5D}"


def with_(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def rx(expr: str, pattern: str, to: str = " ") -> str:
    return f"regexp_replace({expr}, '{pattern}', '{to}', 'g')"


def sql_emails(t: str) -> str:
    return rx(t, r"[a-zA-Z._\-0-9]+@[a-zA-Z._\-0-9]+")


def sql_urls(t: str) -> str:
    return rx(t, rf"(https://|www[^\n])[a-zA-Z0-9]+[^\n][a-z]+[^{WS}]*")


def sql_names(t: str) -> str:
    return rx(t, rf"คุณ[{WS}]*[{TH}]+[{WS}]+")


def sql_boundaries(t: str) -> str:
    body = rx(rx(f"left({t}, length({t}) - 1)", f"([^{TH}])([{TH}])", r"\1 \2"), f"([{TH}])([^{TH}])", r"\1 \2")
    return f"({body} || right({t}, 1))"


def sql_entities(t: str) -> str:
    return f"replace(replace({t}, '&amp;', ' '), '&nbsp;', ' ')"


def sql_split_merged(t: str) -> str:
    return rx(t, "([a-z])([A-Z])", r"\1 \\\\ \2")


def clean_ctes(src: str, out: str, profile: str = "parity") -> str:
    """CTEs that turn ``src(doc_id, t)`` into ``out(doc_id, t)``, cleaned."""
    if profile == "legacy":
        one = rx(sql_urls(sql_emails("replace(t, 'ๆ', ' ')")), "[0-9]+-[0-9]+-[0-9]+")
        a = sql_names(one)
        b = "replace(" + rx("t", r"\.[0-9]+[).] ", " . ") + ", '.', ' . ')"
        c = rx(rx(sql_entities("t"), f"[^{LEGAL_CLASS}]"), " {2,}")
    else:
        parity = profile == "parity"
        # In a replacement two backslashes write one; a plain replace is literal.
        stop, mark, full = (r" \\ ", r"\\\\", r" \\ ") if parity else (" ￼ ", "￼", " ￼ ")
        keep = LEGAL_CLASS if profile == "parity" else LEGAL_CLASS + "￼"
        a = rx(sql_names(sql_urls(sql_emails(rx("t", rf"[{WS}\x{{0E46}}]+")))), r"^[0-9]+[).]*$", stop)
        b = f"replace({rx('t', rf'[.][0-9]+[).][{WS}]', stop)}, '.', '{full}')"
        b = rx(b, mark + ".{0,2}" + mark, stop)
        c = rx(rx(rx(sql_entities("t"), f"[^{keep}]", ""), r"^(-|\||\.|#{1,2})"), " {2,}")
        if profile == "sentence":
            c = rf"replace({c}, '￼', '\\')"
        c = sql_split_merged(c)
    return ",\n".join(
        [
            f"{out}_a AS (SELECT doc_id, {a} AS t FROM {src})",
            f"{out}_b AS (SELECT doc_id, {sql_boundaries('t')} AS t FROM {out}_a)",
            f"{out}_c AS (SELECT doc_id, {b} AS t FROM {out}_b)",
            f"{out} AS (SELECT doc_id, {c} AS t FROM {out}_c)",
        ]
    )


def words_cte(src: str, out: str, stops: tuple[str, ...] = ()) -> str:
    """``out(doc_id, toks)``: words of the cleaned ``src(doc_id, t)``."""
    drop = ", ".join(f"'{s}'" for s in ("", *stops))
    return (
        f"{out} AS (SELECT doc_id, list_transform(list_filter(str_split(t, ' '),"
        f" lambda x: x NOT IN ({drop})), lambda x: lower(x)) AS toks FROM {src})"
    )


def ngram_ctes(src: str, out: str, n: int) -> str:
    """``out(doc_id, toks)``: words of ``src`` and their n-grams, in order."""
    over = "OVER (PARTITION BY doc_id, si ORDER BY pos)"
    leads = ", ".join(f"lead(w, {k}) {over} AS w{k}" for k in range(1, n))
    grams = " UNION ALL ".join(
        f"SELECT doc_id, si, {k} AS k, pos, w" + "".join(f" || sep || w{j}" for j in range(1, k)) + f" AS g FROM {out}_l"
        for k in range(2, n + 1)
    )
    return ",\n".join(
        [
            rf"{out}_s AS (SELECT doc_id, str_split(array_to_string(toks, '|'), '|\\|') AS ss FROM {src})",
            f"{out}_u AS (SELECT doc_id, unnest(ss) AS s, generate_subscripts(ss, 1) AS si FROM {out}_s)",
            f"{out}_w AS (SELECT doc_id, si, list_filter(str_split(s, '|'), lambda x: x <> '') AS ws,"
            f" CASE WHEN regexp_matches(s, '[{TH}]') THEN '' ELSE ' ' END AS sep FROM {out}_u)",
            f"{out}_p AS (SELECT doc_id, si, sep, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM {out}_w)",
            f"{out}_l AS (SELECT *, {leads} FROM {out}_p)",
            f"{out}_n AS ({grams})",
            f"{out}_g AS (SELECT doc_id, list(g ORDER BY si, k, pos) AS gs FROM {out}_n WHERE g IS NOT NULL GROUP BY doc_id)",
            f"{out} AS (SELECT w.doc_id, w.toks || coalesce(g.gs, []) AS toks FROM {src} w"
            f" LEFT JOIN {out}_g g ON w.doc_id = g.doc_id)",
        ]
    )


def token_ctes(src: str, col: str, out: str, n: int, profile: str = "parity", stops=()) -> str:
    """From ``src(doc_id, col)`` to ``out(doc_id, toks)``."""
    return ",\n".join(
        [
            f"{out}_t AS (SELECT doc_id, {col} AS t FROM {src})",
            clean_ctes(f"{out}_t", f"{out}_clean", profile),
            words_cte(f"{out}_clean", f"{out}_words" if n > 1 else out, stops),
        ]
        + ([ngram_ctes(f"{out}_words", out, n)] if n > 1 else [])
    )


TERMS = "CASE WHEN len(toks) = 0 THEN [''] ELSE toks END"
