"""Cleaning steps, one query each, then the three whole profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from doctag.functions import clean as C
from doctag.plans.catalog.registry import (
    DOCS,
    LEGAL_CLASS,
    TH,
    THAI_TEXT,
    WS,
    clean_ctes,
    docs,
    query,
    rx,
    sql_boundaries,
    sql_emails,
    sql_entities,
    sql_names,
    sql_split_merged,
    sql_urls,
    table,
    thai_text,
    with_,
)

ARABIC = "0123456789"
KEYWORDS = ("The", "Er[a-z]")


def pages(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", F.concat_ws(" ", "url", "html").alias("t")
    )


PAGES = "pg AS (SELECT page_id, url || ' ' || html AS t FROM pages)"


def digits_sql() -> str:
    out = f"translate(t, '{ARABIC}', '{C.THAI_DIGITS}')"
    for n, d in enumerate(C.THAI_DIGITS):
        out = f"replace({out}, '{d}', ' {n} ')"
    return out


@query("thai_digits", "T1", with_(PAGES, select=f"SELECT page_id, {digits_sql()} AS text FROM pg"))
def thai_digits(spark, sf):
    t = F.translate("t", ARABIC, C.THAI_DIGITS)
    return pages(spark, sf).select("page_id", C.expand_thai_digits(t).alias("text"))


@query(
    "repeat_mark",
    "T2",
    "SELECT doc_id, replace(translate(text, 'x', 'ๆ'), 'ๆ', ' ') AS text FROM documents",
)
def repeat_mark(spark, sf):
    t = F.translate("desc", "x", C.REPEAT_MARK)
    return docs(spark, sf).select("doc_id", C.blank_repeat_mark(t).alias("text"))


@query(
    "whitespace_runs",
    "T3",
    with_(PAGES, select=f"SELECT page_id, {rx('t', f'[{WS}]+')} AS text FROM pg"),
)
def whitespace_runs(spark, sf):
    return pages(spark, sf).select("page_id", C.squeeze_whitespace(F.col("t")).alias("text"))


@query("emails", "T4", f"SELECT doc_id, {sql_emails('text')} AS text FROM documents")
def emails(spark, sf):
    return docs(spark, sf).select("doc_id", C.blank_emails(F.col("desc")).alias("text"))


@query("urls", "T5", with_(PAGES, select=f"SELECT page_id, {sql_urls('t')} AS text FROM pg"))
def urls(spark, sf):
    return pages(spark, sf).select("page_id", C.blank_urls(F.col("t")).alias("text"))


@query(
    "phones",
    "T6",
    f"SELECT doc_id, {rx('text', '[0-9-]{9,12}')} AS wide,"
    f" {rx('text', '[0-9]+-[0-9]+-[0-9]+')} AS dashed FROM documents",
)
def phones(spark, sf):
    return docs(spark, sf).select(
        "doc_id",
        C.blank_phones(F.col("desc")).alias("wide"),
        C.blank_dashed_phones(F.col("desc")).alias("dashed"),
    )


@query(
    "thai_names",
    "T7",
    with_(
        THAI_TEXT,
        select=f"SELECT doc_id, {sql_names(rx('t', f'[{TH}]', 'คุณกข'))} AS text FROM thai",
    ),
)
def thai_names(spark, sf):
    t = F.regexp_replace("t", "[ก-๛]", "คุณกข")
    return thai_text(spark, sf).select("doc_id", C.blank_thai_names(t).alias("text"))


@query(
    "lone_bullet",
    "T8",
    r"SELECT doc_id, regexp_replace(CAST(n_chars AS VARCHAR) || lang || ')', '^[0-9]+[).]*$', ' \\ ') AS with_letter,"
    r" regexp_replace(CAST(n_chars AS VARCHAR) || ').', '^[0-9]+[).]*$', ' \\ ') AS bullet FROM documents",
)
def lone_bullet(spark, sf):
    n = F.col("n_chars").cast("string")
    return table(spark, sf, "documents").select(
        "doc_id",
        C.mark_lone_bullet(F.concat(n, "lang", F.lit(")"))).alias("with_letter"),
        C.mark_lone_bullet(F.concat(n, F.lit(")."))).alias("bullet"),
    )


@query(
    "keywords_lowered",
    "T9",
    f"SELECT doc_id, {rx(rx('text', 'The', 'the'), 'Er[a-z]', 'er[a-z]')} AS text FROM documents",
)
def keywords_lowered(spark, sf):
    return docs(spark, sf).select("doc_id", C.lower_keywords(F.col("desc"), KEYWORDS).alias("text"))


@query(
    "thai_boundaries",
    "T10",
    with_(THAI_TEXT, select=f"SELECT doc_id, {sql_boundaries('t')} AS text FROM thai"),
)
def thai_boundaries(spark, sf):
    return thai_text(spark, sf).select("doc_id", C.space_thai_boundaries(F.col("t")).alias("text"))


@query(
    "inner_bullets",
    "T11",
    "SELECT doc_id, "
    + rx("replace(text, '. ', '.12) ')", f"[.][0-9]+[).][{WS}]", r" \\ ")
    + " AS text FROM documents",
)
def inner_bullets(spark, sf):
    t = F.replace("desc", F.lit(". "), F.lit(".12) "))
    return docs(spark, sf).select("doc_id", C.mark_inner_bullets(t).alias("text"))


@query("full_stops", "T12", r"SELECT doc_id, replace(text, '.', ' \\ ') AS text FROM documents")
def full_stops(spark, sf):
    return docs(spark, sf).select("doc_id", C.mark_full_stops(F.col("desc")).alias("text"))


@query(
    "close_markers",
    "T13",
    "SELECT doc_id, "
    + rx(r"replace(replace(text, '. ', '..'), '.', ' \\ ')", r"\\\\.{0,2}\\\\", r" \\ ")
    + " AS text FROM documents",
)
def close_markers(spark, sf):
    t = C.mark_full_stops(F.replace("desc", F.lit(". "), F.lit("..")))
    return docs(spark, sf).select("doc_id", C.merge_markers(t).alias("text"))


@query("entities", "T14", with_(PAGES, select=f"SELECT page_id, {sql_entities('t')} AS text FROM pg"))
def entities(spark, sf):
    return pages(spark, sf).select("page_id", C.blank_entities(F.col("t")).alias("text"))


@query(
    "illegal_characters",
    "T15 S8",
    f"SELECT doc_id, {rx('text', f'[^{LEGAL_CLASS}]', '')} AS text FROM documents",
)
def illegal_characters(spark, sf):
    return docs(spark, sf).select("doc_id", C.drop_illegal(F.col("desc")).alias("text"))


@query(
    "leading_garbage",
    "T16",
    "SELECT doc_id, regexp_replace(substr('-|.##a', CAST(1 + doc_id % 6 AS INTEGER)) || text,"
    r" '^(-|\||\.|#{1,2})', ' ') AS text FROM documents",
)
def leading_garbage(spark, sf):
    lead = F.substring(F.lit("-|.##a"), (F.col("doc_id") % 6 + 1).cast("int"), F.lit(6))
    return docs(spark, sf).select(
        "doc_id", C.blank_leading_garbage(F.concat(lead, "desc")).alias("text")
    )


@query(
    "merged_words",
    "T17 T34",
    f"SELECT doc_id, {sql_split_merged(rx(rx('text', '[^A-Za-z]+', ''), ' {2,}'))} AS text FROM documents",
)
def merged_words(spark, sf):
    t = F.regexp_replace("desc", r"[\x{0}-@\[-`{-\x{10FFFF}]+", "")
    return docs(spark, sf).select(
        "doc_id", C.split_merged_words(C.squeeze_spaces(t)).alias("text")
    )


def _cleaned(profile: str):
    sql = with_(THAI_TEXT, clean_ctes("thai", "c", profile), select="SELECT doc_id, t AS text FROM c")

    @query(f"clean_{profile}", "T1 T2 T3 T4 T5 T7 T8 T10 T11 T12 T13 T14 T15 T16 T17 X2", sql)
    def run(spark, sf):
        options = C.CleanOptions(profile=profile)
        return thai_text(spark, sf).select("doc_id", C.clean(F.col("t"), options).alias("text"))


for _profile in ("parity", "sentence", "legacy"):
    _cleaned(_profile)


@query(
    "clean_titles",
    "T18 X2",
    with_(
        DOCS,
        "src AS (SELECT doc_id, title AS t FROM docs)",
        clean_ctes("src", "c"),
        select="SELECT doc_id, t AS title FROM c",
    ),
)
def clean_titles(spark, sf):
    return docs(spark, sf).select("doc_id", C.clean(F.col("title")).alias("title"))
