"""Filters, columns, unions and reviews of document sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from doctag.operators import dataset as D
from doctag.operators.order import with_row_number
from doctag.operators.sampling import exclude_sampled, mark_sampled
from doctag.plans.catalog.registry import (
    DOCS,
    LABELLED,
    TAGGED,
    docs,
    labelled_docs,
    query,
    sql_id,
    table,
    tagged_docs,
    token_ctes,
    with_,
)
from doctag.plans.training import cutoff

# A prediction column for the filters: the toxic mark stands for a predicted tag.
PREDICTED = (
    "predicted AS (SELECT doc_id, CAST(quality AS VARCHAR) AS tag, CAST(toxic AS VARCHAR) AS predict FROM labels)"
)


def predicted(spark, sf):
    return table(spark, sf, "labels").select(
        "doc_id",
        F.col("quality").cast("string").alias("tag"),
        F.col("toxic").cast("string").alias("predict"),
    )


@query("columns_selected", "F1 M1", with_(DOCS, TAGGED, select='SELECT title, body AS "desc", tag FROM tagged'))
def columns_selected(spark, sf):
    return tagged_docs(spark, sf).select("title", "desc", "tag")


@query(
    "columns_dropped",
    "F2",
    with_(DOCS, select='SELECT doc_id, title, body AS "desc", length(body) AS n FROM docs'),
)
def columns_dropped(spark, sf):
    wide = docs(spark, sf).withColumns(
        {"title_seg": F.split("title", " "), "desc_seg": F.split("desc", " "), "n": F.length("desc").cast("long")}
    )
    return wide.drop("title_seg", "desc_seg")


@query(
    "title_keywords",
    "F3",
    with_(
        DOCS,
        select="SELECT doc_id, title FROM docs WHERE contains(title, 'The') OR contains(title, 'eaux')"
        " OR contains(title, 'Un')",
    ),
)
def title_keywords(spark, sf):
    return D.title_contains(docs(spark, sf), ["The", "eaux", "Un"]).select("doc_id", "title")


@query("long_enough", "F4", with_(DOCS, select="SELECT doc_id, length(body) AS n FROM docs WHERE length(body) > 60"))
def long_enough(spark, sf):
    return D.min_length(docs(spark, sf)).select("doc_id", F.length("desc").cast("long").alias("n"))


@query("label_filter", "F5", with_(PREDICTED, select="SELECT * FROM predicted WHERE predict = '1'"))
def label_filter(spark, sf):
    return D.by_label(predicted(spark, sf), "1")


@query("mispredicted", "F6 L14", with_(PREDICTED, select="SELECT * FROM predicted WHERE tag IS DISTINCT FROM predict"))
def mispredicted(spark, sf):
    return D.mispredicted(predicted(spark, sf))


SAMPLED = "sampled AS (SELECT doc_id, quality = 0 AS sampled FROM labels)"


@query("not_yet_sampled", "F8", with_(SAMPLED, select="SELECT * FROM sampled WHERE NOT sampled"))
def not_yet_sampled(spark, sf):
    marked = table(spark, sf, "labels").select("doc_id", (F.col("quality") == 0).alias("sampled"))
    return D.not_sampled(marked)


@query(
    "row_slice",
    "F9",
    "SELECT p_partkey, p_name FROM part QUALIFY row_number() OVER (ORDER BY p_partkey) BETWEEN 101 AND 750",
)
def row_slice(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    return D.slice_rows(parts, "p_partkey", 100, 750)


@query(
    "row_slice_open",
    "F9",
    "SELECT doc_id, n_chars FROM documents QUALIFY row_number() OVER (ORDER BY doc_id) > 120",
)
def row_slice_open(spark, sf):
    return D.slice_rows(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id", 120)


@query(
    "columns_from_expressions",
    "F10",
    with_(DOCS, select="SELECT doc_id, length(body) AS chars, length(title) AS head FROM docs"),
)
def columns_from_expressions(spark, sf):
    exprs = {"head": F.length("title").cast("long"), "chars": F.length("desc").cast("long")}
    return D.add_columns(docs(spark, sf), exprs).select("doc_id", "chars", "head")


@query(
    "columns_from_table",
    "F10 J4",
    "SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
)
def columns_from_table(spark, sf):
    base = table(spark, sf, "documents").select("doc_id", "lang")
    return D.add_columns(base, other=table(spark, sf, "labels"), key="doc_id")


@query(
    "one_vs_rest",
    "F12",
    with_(
        DOCS,
        TAGGED,
        select="SELECT doc_id, CASE WHEN tag = '1' THEN tag ELSE '!1' END AS tag FROM tagged",
    ),
)
def one_vs_rest(spark, sf):
    return D.one_vs_rest(tagged_docs(spark, sf), "1").select("doc_id", "tag")


@query("document_ids", "F13", with_(DOCS, select=f"SELECT doc_id, {sql_id('run-7')} AS job_id FROM docs"))
def document_ids(spark, sf):
    return docs(spark, sf).select("doc_id", D.document_id("run-7", "doc_id").alias("job_id"))


@query("document_ids_unique", "F13", "SELECT count(*) AS documents, count(*) AS ids FROM documents")
def document_ids_unique(spark, sf):
    """Copies get ids of their own, with and without a key."""
    ids = docs(spark, sf).select(
        D.document_id("run-7", "doc_id").alias("a"), D.document_id("run-7").alias("b")
    )
    return ids.agg(
        F.count(F.lit(1)).alias("documents"),
        F.least(F.count_distinct("a"), F.count_distinct("b")).alias("ids"),
    )


@query(
    "renumbered",
    "F14",
    with_(
        DOCS,
        select="SELECT doc_id, title, row_number() OVER (ORDER BY doc_id) - 1 AS row FROM docs WHERE length(body) > 60",
    ),
)
def renumbered(spark, sf):
    return D.renumber(D.min_length(docs(spark, sf)).select("doc_id", "title"), "doc_id")


@query("blank_document_set", "F15 S3 U1", with_(DOCS, TAGGED, select='SELECT title, body AS "desc", tag, CAST(doc_id AS VARCHAR) AS origin FROM tagged'))
def blank_document_set(spark, sf):
    from doctag.sources.documents import documents

    blank = documents(spark, add_column=["origin"])
    rows = tagged_docs(spark, sf).select(
        "title", "desc", "tag", F.col("doc_id").cast("string").alias("origin")
    )
    return D.append(blank, rows).select("title", "desc", "tag", "origin")


DECISIONS = (
    "decisions AS (SELECT doc_id, CASE WHEN toxic = 1 THEN '-' WHEN doc_id % 5 = 0 THEN '+'"
    " WHEN doc_id % 5 = 1 THEN '.' WHEN doc_id % 5 = 2 THEN '?' ELSE '' END AS code FROM labels)"
)


def decisions(spark, sf):
    five = F.col("doc_id") % 5
    code = (
        F.when(F.col("toxic") == 1, "-").when(five == 0, "+").when(five == 1, ".").when(five == 2, "?").otherwise("")
    )
    return table(spark, sf, "labels").select("doc_id", code.alias("code"))


@query(
    "reviewed_tags",
    "F16",
    with_(
        DOCS,
        TAGGED,
        DECISIONS,
        select="SELECT t.doc_id, CASE code WHEN '' THEN 'IT' WHEN '-' THEN '!IT' WHEN '+' THEN 'STEM'"
        " WHEN '.' THEN 'not sure' ELSE tag END AS tag FROM tagged t LEFT JOIN decisions c ON t.doc_id = c.doc_id",
    ),
)
def reviewed_tags(spark, sf):
    rows = tagged_docs(spark, sf).select("doc_id", "tag")
    tagged, _ = D.apply_decisions(rows, decisions(spark, sf), "doc_id", "IT", "STEM", "!IT")
    return tagged


@query("rejected_reviews", "F16", with_(DECISIONS, select="SELECT * FROM decisions WHERE code = '?'"))
def rejected_reviews(spark, sf):
    rows = tagged_docs(spark, sf).select("doc_id", "tag")
    _, rejected = D.apply_decisions(rows, decisions(spark, sf), "doc_id", "IT", "STEM", "!IT")
    return rejected


@query(
    "score_cutoff",
    "F17 F18 X4",
    "SELECT doc_id, n_chars, CASE WHEN n_chars / 5000.0 > 0.5 THEN '1' ELSE '0' END AS predict FROM documents",
)
def score_cutoff(spark, sf):
    scored = table(spark, sf, "documents").select("doc_id", "n_chars")
    return cutoff(scored, F.col("n_chars") / 5000.0, 0.5)


@query(
    "document_set_again",
    "F19 S3",
    with_(
        DOCS,
        TAGGED,
        token_ctes("docs", "title", "a", 5),
        token_ctes("docs", "body", "b", 5),
        select=f"SELECT t.doc_id, {sql_id('again', 't.')} AS job_id, title, body AS \"desc\", tag,"
        " array_to_string(a.toks, '|') AS title_seg, array_to_string(b.toks, '|') AS desc_seg, false AS sampled"
        " FROM tagged t JOIN a ON t.doc_id = a.doc_id JOIN b ON t.doc_id = b.doc_id WHERE length(body) > 60",
    ),
)
def document_set_again(spark, sf):
    used = tagged_docs(spark, sf).withColumns({"sampled": F.lit(True), "note": F.lit("x")})
    return D.reinit(used, salt="again", keep=["doc_id"], key="doc_id")


LEDGER = "ledger AS (SELECT doc_id FROM labels WHERE toxic = 1 OR quality = 0)"


def ledger(spark, sf):
    return table(spark, sf, "labels").filter((F.col("toxic") == 1) | (F.col("quality") == 0)).select("doc_id")


@query(
    "sampled_excluded",
    "J5",
    with_(LEDGER, select="SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM ledger)"),
)
def sampled_excluded(spark, sf):
    return exclude_sampled(table(spark, sf, "documents").select("doc_id", "lang"), ledger(spark, sf), "doc_id")


@query(
    "sampled_marked",
    "J6",
    with_(
        LEDGER,
        select="SELECT d.doc_id, l.doc_id IS NOT NULL AS sampled FROM documents d LEFT JOIN ledger l ON d.doc_id = l.doc_id",
    ),
)
def sampled_marked(spark, sf):
    return mark_sampled(table(spark, sf, "documents").select("doc_id"), ledger(spark, sf), "doc_id")


@query(
    "first_rows",
    "W5",
    with_(
        DOCS,
        select='SELECT doc_id, title, body AS "desc", row_number() OVER (ORDER BY doc_id) AS position FROM docs'
        " ORDER BY doc_id LIMIT 4",
    ),
)
def first_rows(spark, sf):
    return with_row_number(D.head(docs(spark, sf), "doc_id"), [F.col("doc_id")], "position")


@query(
    "sorted_rows",
    "W2",
    "SELECT doc_id, source, n_chars, row_number() OVER (ORDER BY source DESC, n_chars, doc_id) AS position"
    " FROM documents",
)
def sorted_rows(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    return with_row_number(rows, [F.desc("source"), F.col("n_chars"), F.col("doc_id")], "position")


@query(
    "values_per_column",
    "A3",
    with_(DOCS, TAGGED, select='SELECT count(doc_id) AS doc_id, count(title) AS title, count(body) AS "desc", count(tag) AS tag FROM tagged'),
)
def values_per_column(spark, sf):
    return D.non_null_counts(tagged_docs(spark, sf))


@query("label_counts", "A3", with_(DOCS, TAGGED, select="SELECT tag, count(*) AS documents FROM tagged GROUP BY tag"))
def label_counts(spark, sf):
    return D.label_counts(tagged_docs(spark, sf))


@query(
    "appended_sets",
    "U1 U4 U6",
    "SELECT text, lang, source FROM documents UNION ALL SELECT text, NULL, 'benchmark' FROM benchmark"
    " UNION ALL SELECT text, role, NULL FROM conversations",
)
def appended_sets(spark, sf):
    base = table(spark, sf, "documents").select("text", "lang", "source")
    bench = table(spark, sf, "benchmark").select("text", F.lit("benchmark").alias("source"))
    talk = table(spark, sf, "conversations").select("text", F.col("role").alias("lang"))
    return D.append(base, [bench, talk])


@query(
    "appended_self",
    "U1",
    "SELECT doc_id, quality FROM labels UNION ALL SELECT doc_id, quality FROM labels",
)
def appended_self(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return D.append(labels, labels)
