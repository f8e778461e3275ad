"""Tokenizing, n-grams, stop words, lemmas and segmentation."""

from __future__ import annotations

from pyspark.sql import functions as F

from doctag.functions import tokens as T
from doctag.functions.clean import CleanOptions
from doctag.functions.segment import dictionary_segmenter, longest_match
from doctag.operators.dataset import preprocess, tokenize_documents
from doctag.operators.lemmas import drop_words_by_join, lemmatize_by_join
from doctag.operators.token_tables import TokenTables, tokenize_by_tables
from doctag.plans.catalog.registry import (
    DOCS,
    TAGGED,
    TH,
    THAI_LETTERS,
    THAI_TEXT,
    clean_ctes,
    docs,
    ngram_ctes,
    query,
    sql_id,
    table,
    tagged_docs,
    thai_text,
    token_ctes,
    with_,
    words_cte,
)

# Settings of the queries below, in the fixture's own words.
STOP_EN = ("the", "of", "and", "la", "der", "que")
LEMMAS = {"ores": "ore", "ones": "one", "hated": "hate", "des": "de", "ou": "ouo", "zer": "z"}
PHRASES = ("the", "of the", "and", "en la")
SEGMENTS = ("กข", "ข", "คง", "กขค", "จฉ")


def text_of(toks: str = "toks") -> str:
    return f"array_to_string({toks}, '|')"


def lemma_case(x: str, keywords=()) -> str:
    cases = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in LEMMAS.items())
    keep = f" AND {x} NOT IN ({', '.join(repr(k) for k in keywords)})" if keywords else ""
    return f"CASE WHEN regexp_matches({x}, '^[A-Ya-y]*$'){keep} THEN (CASE {x} {cases} ELSE {x} END) ELSE {x} END"


@query(
    "words",
    "T18 T19",
    with_(THAI_TEXT, token_ctes("thai", "t", "k", 1), select=f"SELECT doc_id, {text_of()} AS tokens FROM k"),
)
def words(spark, sf):
    return thai_text(spark, sf).select("doc_id", T.token_text(T.words(F.col("t"))).alias("tokens"))


@query(
    "words_without_english_stops",
    "T19 J7",
    with_(
        DOCS,
        token_ctes("docs", "body", "k", 1, stops=STOP_EN),
        select=f"SELECT doc_id, {text_of()} AS tokens FROM k",
    ),
)
def words_without_english_stops(spark, sf):
    options = T.TokenOptions(stop_en=STOP_EN)
    return docs(spark, sf).select(
        "doc_id", T.token_text(T.words(F.col("desc"), options)).alias("tokens")
    )


@query(
    "words_without_thai_stops",
    "T22",
    with_(
        THAI_TEXT,
        token_ctes("thai", "t", "k", 1),
        select="SELECT doc_id, array_to_string(list_filter(toks, lambda x: x NOT IN ('ก', 'ขค')), '|')"
        " AS tokens FROM k",
    ),
)
def words_without_thai_stops(spark, sf):
    options = T.TokenOptions(stop_th=("ก", "ขค"))
    return thai_text(spark, sf).select(
        "doc_id", T.token_text(T.words(F.col("t"), options)).alias("tokens")
    )


LEMMA_SQL = with_(
    DOCS,
    token_ctes("docs", "body", "k", 1),
    select=f"SELECT doc_id, array_to_string(list_transform(toks, lambda x: {lemma_case('x', ('ones',))}), '|')"
    " AS tokens FROM k",
)


@query("lemmas", "T20", LEMMA_SQL)
def lemmas(spark, sf):
    options = T.TokenOptions(lemmas=LEMMAS, keywords=("ones",))
    return docs(spark, sf).select(
        "doc_id", T.token_text(T.words(F.col("desc"), options)).alias("tokens")
    )


@query("lemmas_by_join", "T20", LEMMA_SQL)
def lemmas_by_join(spark, sf):
    plain = docs(spark, sf, keyed=True).select("doc_id", T.words(F.col("desc")).alias("tokens"))
    known = spark.createDataFrame(list(LEMMAS.items()), "token string, lemma string")
    out = lemmatize_by_join(plain, "doc_id", "tokens", known, keywords=("ones",))
    return out.select("doc_id", T.token_text(F.col("tokens")).alias("tokens"))


BENCH_WORDS = "stops AS (SELECT DISTINCT unnest(str_split(lower(text), ' ')) AS token FROM benchmark)"


@query(
    "stop_words_by_join",
    "J7 T19 S7",
    with_(
        DOCS,
        token_ctes("docs", "body", "k", 1),
        BENCH_WORDS,
        "u AS (SELECT doc_id, unnest(toks) AS token, generate_subscripts(toks, 1) AS i FROM k)",
        "kept AS (SELECT doc_id, string_agg(token, '|' ORDER BY i) AS tokens FROM u"
        " WHERE token NOT IN (SELECT token FROM stops) GROUP BY doc_id)",
        select="SELECT k.doc_id, coalesce(tokens, '') AS tokens FROM k LEFT JOIN kept ON k.doc_id = kept.doc_id",
    ),
)
def stop_words_by_join(spark, sf):
    plain = docs(spark, sf, keyed=True).select("doc_id", T.words(F.col("desc")).alias("tokens"))
    stops = table(spark, sf, "benchmark").select(F.explode(F.split(F.lower("text"), " ")).alias("token"))
    out = drop_words_by_join(plain, "doc_id", "tokens", stops)
    return out.select("doc_id", T.token_text(F.col("tokens")).alias("tokens"))


@query(
    "sentence_split",
    "T23",
    with_(
        DOCS,
        token_ctes("docs", "body", "k", 1, profile="sentence"),
        rf"s AS (SELECT doc_id, str_split({text_of()}, '|\\|') AS ss FROM k)",
        select="SELECT doc_id, unnest(ss) AS sentence, CAST(generate_subscripts(ss, 1) - 1 AS INTEGER) AS n FROM s",
    ),
)
def sentence_split(spark, sf):
    options = T.TokenOptions(cleaning=CleanOptions(profile="sentence"))
    toks = docs(spark, sf).select("doc_id", T.words(F.col("desc"), options).alias("toks"))
    return toks.select("doc_id", F.posexplode(T.sentences(F.col("toks"))).alias("n", "sentence"))


@query(
    "trigrams",
    "T24",
    with_(
        THAI_TEXT,
        token_ctes("thai", "t", "k", 1),
        "p AS (SELECT doc_id, unnest(toks) AS w, generate_subscripts(toks, 1) AS pos FROM k)",
        "l AS (SELECT doc_id, pos, w || '~' || lead(w) OVER d || '~' || lead(w, 2) OVER d AS g FROM p"
        " WINDOW d AS (PARTITION BY doc_id ORDER BY pos))",
        "g AS (SELECT doc_id, string_agg(g, '|' ORDER BY pos) AS gs FROM l WHERE g IS NOT NULL GROUP BY doc_id)",
        select="SELECT k.doc_id, coalesce(gs, '') AS grams FROM k LEFT JOIN g ON k.doc_id = g.doc_id",
    ),
)
def trigrams(spark, sf):
    toks = thai_text(spark, sf).select("doc_id", T.words(F.col("t")).alias("toks"))
    return toks.select(
        "doc_id", F.array_join(T.ngrams_of(F.col("toks"), 3, F.lit("~")), "|").alias("grams")
    )


@query(
    "all_ngrams",
    "T18 T25 T26",
    with_(THAI_TEXT, token_ctes("thai", "t", "k", 4), select=f"SELECT doc_id, {text_of()} AS tokens FROM k"),
)
def all_ngrams(spark, sf):
    options = T.TokenOptions(ngram=4)
    return thai_text(spark, sf).select(
        "doc_id", T.token_text(T.tokenize(F.col("t"), options)).alias("tokens")
    )


@query(
    "sentence_ngrams",
    "T18 T25",
    with_(
        DOCS,
        token_ctes("docs", "body", "k", 3, profile="sentence"),
        select=f"SELECT doc_id, {text_of()} AS tokens FROM k",
    ),
)
def sentence_ngrams(spark, sf):
    options = T.TokenOptions(ngram=3, cleaning=CleanOptions(profile="sentence"))
    return docs(spark, sf).select(
        "doc_id", T.token_text(T.tokenize(F.col("desc"), options)).alias("tokens")
    )


@query(
    "tokenized_documents",
    "T27 T28",
    with_(
        DOCS,
        token_ctes("docs", "title", "a", 5),
        token_ctes("docs", "body", "b", 4),
        select="SELECT a.doc_id, array_to_string(a.toks, '|') AS title_seg, array_to_string(b.toks, '|') AS desc_seg"
        " FROM a JOIN b ON a.doc_id = b.doc_id",
    ),
)
def tokenized_documents(spark, sf):
    return tokenize_documents(docs(spark, sf)).select("doc_id", "title_seg", "desc_seg")


@query(
    "document_set",
    "T29 F13 M2",
    with_(
        DOCS,
        TAGGED,
        token_ctes("docs", "title", "a", 5),
        token_ctes("docs", "body", "b", 5),
        select=f"SELECT t.doc_id, {sql_id('batch-1', 't.')} AS job_id, title, body AS \"desc\", tag,"
        " array_to_string(a.toks, '|') AS title_seg, array_to_string(b.toks, '|') AS desc_seg, false AS sampled"
        " FROM tagged t JOIN a ON t.doc_id = a.doc_id JOIN b ON t.doc_id = b.doc_id",
    ),
)
def document_set(spark, sf):
    return preprocess(tagged_docs(spark, sf), salt="batch-1", key="doc_id")


@query(
    "token_text_list",
    "T30 M3",
    with_(
        DOCS,
        token_ctes("docs", "title", "k", 2),
        select=f"SELECT doc_id, len(str_split({text_of()}, '|')) AS n, str_split({text_of()}, '|')[1] AS first FROM k",
    ),
)
def token_text_list(spark, sf):
    text = T.token_text(T.tokenize(F.col("title"), T.TokenOptions(ngram=2)))
    rows = docs(spark, sf).select("doc_id", T.split_token_text(text).alias("toks"))
    return rows.select(
        "doc_id", F.size("toks").cast("long").alias("n"), F.get("toks", F.lit(0)).alias("first")
    )


@query(
    "token_text_set",
    "T31 U5",
    with_(
        DOCS,
        token_ctes("docs", "body", "k", 2),
        select=f"SELECT DISTINCT doc_id, unnest(str_split({text_of()}, '|')) AS token FROM k",
    ),
)
def token_text_set(spark, sf):
    text = T.token_text(T.tokenize(F.col("desc"), T.TokenOptions(ngram=2)))
    return docs(spark, sf).select(
        "doc_id", F.explode(F.array_distinct(T.split_token_text(text))).alias("token")
    )


def _legacy_sql(stops: str = "t") -> str:
    thai_word = f"regexp_matches(w, '[{TH}]') AND length(w) > 1"
    return with_(
        THAI_TEXT,
        clean_ctes("thai", "c0", "legacy"),
        f"c AS (SELECT doc_id, {stops} AS t FROM c0)",
        "k AS (SELECT doc_id, list_filter(str_split(t, ' '), lambda x: x NOT IN ("
        + ", ".join(f"'{s}'" for s in STOP_EN)
        + r") AND NOT regexp_matches(x, '^[0-9]+[).]*$')) AS toks FROM c)",
        "p AS (SELECT doc_id, flatten(list_transform(toks, lambda w: CASE WHEN "
        + thai_word
        + " THEN [w] ELSE str_split(lower(regexp_replace(w, '^(.*?[a-z])([A-Z].*)$', '\\1|\\2')), '|') END)) AS ws FROM k)",
        "g AS (SELECT doc_id, ws, list_transform(list_filter(range(1, len(ws)), lambda i: len(list_filter(ws[i:i + 1],"
        f" lambda w: {thai_word})) = 2), lambda i: array_to_string(ws[i:i + 1], '')) AS gs FROM p)",
        select="SELECT DISTINCT doc_id, unnest(ws || gs) AS token FROM g",
    )


@query("legacy_tokens", "T32 T34", _legacy_sql())
def legacy_tokens(spark, sf):
    options = T.TokenOptions(ngram=2, stop_en=STOP_EN)
    return thai_text(spark, sf).select(
        "doc_id", F.explode(T.legacy_tokens(F.col("t"), options)).alias("token")
    )


@query(
    "stop_phrases",
    "T33",
    "SELECT doc_id, regexp_replace(text, 'the|and|en la|of the', ' ', 'g') AS text FROM documents",
)
def stop_phrases(spark, sf):
    return docs(spark, sf).select("doc_id", T.cut_phrases(F.col("desc"), PHRASES).alias("text"))


SEGMENT_SQL = with_(
    f"thai AS (SELECT doc_id, translate(text, 'aeioun', '{THAI_LETTERS}') AS t FROM documents)",
    clean_ctes("thai", "c"),
    words_cte("c", "k"),
    "s AS (SELECT doc_id, flatten(list_transform(toks, lambda w:"
    f" CASE WHEN regexp_matches(w, '[{TH}]') THEN regexp_extract_all(w, '(?s)(กขค|กข|คง|จฉ|ข|.)') ELSE [w] END))"
    " AS toks FROM k)",
    select=f"SELECT doc_id, {text_of()} AS tokens FROM s",
)


def thai_words(spark, sf):
    return docs(spark, sf).select("doc_id", F.translate("desc", "aeioun", THAI_LETTERS).alias("t"))


@query("segmented_words", "T21", SEGMENT_SQL)
def segmented_words(spark, sf):
    options = T.TokenOptions(segmenter=dictionary_segmenter(SEGMENTS))
    return thai_words(spark, sf).select(
        "doc_id", T.token_text(T.words(F.col("t"), options)).alias("tokens")
    )


@query("segmented_words_by_function", "T21 X1", SEGMENT_SQL)
def segmented_words_by_function(spark, sf):
    options = T.TokenOptions(th_tokenizer=longest_match(SEGMENTS))
    return thai_words(spark, sf).select(
        "doc_id", T.token_text(T.words(F.col("t"), options)).alias("tokens")
    )


@query(
    "words_by_own_cleaner",
    "X2 T19",
    with_(
        "own AS (SELECT doc_id, regexp_replace(replace(text, '&', ' and '), '[^A-Za-z ]+', ' ', 'g') AS t FROM documents)",
        words_cte("own", "kept", ("the", "of")),
        select="SELECT doc_id, array_to_string(toks, '|') AS tokens FROM kept",
    ),
)
def words_by_own_cleaner(spark, sf):
    """Tokens of texts that another cleaner than the library's has cleaned."""

    def letters(text):
        return F.regexp_replace(F.replace(text, F.lit("&"), F.lit(" and ")), "[^A-Za-z ]+", " ")

    options = T.TokenOptions(ngram=1, cleaner=letters, stop_en=("the", "of"))
    rows = table(spark, sf, "documents").select("doc_id", "text")
    return rows.select("doc_id", T.token_text(T.tokenize(F.col("text"), options)).alias("tokens"))


# Tables of over a thousand entries: words of the benchmark and of the documents, their
# lemmas without the last letter, and Thai words spelt by the keys of the parts.
MANY_LEMMAS = (
    "lemma AS (SELECT DISTINCT token, left(token, length(token) - 1) AS lemma FROM (SELECT unnest(str_split(lower(text), ' ')) AS token"
    " FROM benchmark UNION ALL SELECT lower(unnest(str_split(title, ' '))) FROM docs) WHERE length(token) > 4)"
)
MANY_STOPS = "stop AS (SELECT DISTINCT unnest(str_split(replace(left(text, 400), chr(10), ' '), ' ')) AS token FROM benchmark)"


def many_lemmas(spark, sf):
    benchmark = table(spark, sf, "benchmark").select(F.explode(F.split(F.lower("text"), " ")).alias("token"))
    titles = docs(spark, sf).select(F.explode(F.split(F.lower("title"), " ")).alias("token"))
    rows = benchmark.unionByName(titles).filter(F.length("token") > 4).distinct()
    return rows.select("token", F.left("token", F.length("token") - 1).alias("lemma"))


@query(
    "lemmas_by_table_ngrams",
    "T20 J7 T19 T24",
    with_(
        DOCS,
        MANY_LEMMAS,
        MANY_STOPS,
        "raws AS (SELECT doc_id, body AS t FROM docs)",
        clean_ctes("raws", "cleaned"),
        "spelt AS (SELECT doc_id, list_filter(str_split(t, ' '), lambda x: x <> '') AS toks FROM cleaned)",
        "one AS (SELECT doc_id, unnest(toks) AS raw, generate_subscripts(toks, 1) AS i FROM spelt)",
        "mapped AS (SELECT doc_id, i, CASE WHEN lemma IS NOT NULL AND regexp_full_match(lower(raw), '[A-Ya-y]*') THEN lemma ELSE lower(raw) END AS tok"
        " FROM one LEFT JOIN lemma ON lower(raw) = lemma.token WHERE raw NOT IN (SELECT token FROM stop))",
        "plain AS (SELECT s.doc_id, coalesce(list(tok ORDER BY i) FILTER (tok IS NOT NULL), []) AS toks FROM spelt s"
        " LEFT JOIN mapped m ON s.doc_id = m.doc_id GROUP BY s.doc_id)",
        ngram_ctes("plain", "grams", 3),
        select=f"SELECT doc_id, {text_of()} AS tokens FROM grams",
    ),
)
def lemmas_by_table_ngrams(spark, sf):
    """N-grams of documents whose lemmas and stop words are tables."""
    stops = table(spark, sf, "benchmark").select(
        F.explode(F.split(F.replace(F.left("text", F.lit(400)), F.lit("\n"), F.lit(" ")), " ")).alias("token")
    )
    tables = TokenTables(stops=stops, lemmas=many_lemmas(spark, sf))
    out = tokenize_by_tables(docs(spark, sf), "doc_id", {"tokens": ("desc", 3)}, tables)
    return out.select("doc_id", T.token_text(F.col("tokens")).alias("tokens"))


WORDS_OF_PARTS = "translate(lpad(CAST(p_partkey AS VARCHAR), 3 + p_size % 2, '0'), '0123456789', 'กขคงจฉกขคง')"


@query(
    "segmented_by_table",
    "T21 J7 T22",
    with_(
        THAI_TEXT,
        clean_ctes("thai", "cleaned"),
        words_cte("cleaned", "plain"),
        f"word AS (SELECT DISTINCT {WORDS_OF_PARTS} AS word FROM part)",
        "u AS (SELECT doc_id, unnest(toks) AS token, generate_subscripts(toks, 1) AS i FROM plain)",
        f"tokens AS (SELECT DISTINCT token FROM u WHERE regexp_matches(token, '[{TH}]'))",
        "walk(token, pos, n) AS (SELECT token, 1::BIGINT, 0::BIGINT FROM tokens UNION ALL"
        " SELECT w.token, w.pos + w.n, coalesce(length(e.word), length(d.word), length(c.word), 1)::BIGINT"
        " FROM walk w LEFT JOIN word e ON e.word = substr(w.token, w.pos + w.n, 5) AND length(e.word) = 5"
        " LEFT JOIN word d ON d.word = substr(w.token, w.pos + w.n, 4) AND length(d.word) = 4"
        " LEFT JOIN word c ON c.word = substr(w.token, w.pos + w.n, 3) AND length(c.word) = 3"
        " WHERE w.pos + w.n <= length(w.token))",
        "cut AS (SELECT token, list(substr(token, pos, n) ORDER BY pos) AS pieces FROM walk WHERE n > 0 GROUP BY token)",
        "parts AS (SELECT doc_id, i, coalesce(list_filter(pieces, lambda p: p <> 'ก'), [u.token]) AS pieces FROM u"
        " LEFT JOIN cut ON u.token = cut.token)",
        select="SELECT p.doc_id, coalesce((SELECT array_to_string(flatten(list(pieces ORDER BY i)), '|') FROM parts q"
        " WHERE q.doc_id = p.doc_id), '') AS tokens FROM plain p",
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def segmented_by_table(spark, sf):
    """Thai tokens cut into the words of a table, without one Thai stop word."""
    spelt = F.lpad(F.col("p_partkey").cast("string"), 3 + F.col("p_size") % 2, F.lit("0"))
    words = table(spark, sf, "part").select(F.translate(spelt, "0123456789", "กขคงจฉกขคง").alias("word"))
    stops = spark.createDataFrame([("ก",)], "token string")
    out = tokenize_by_tables(thai_text(spark, sf), "doc_id", {"tokens": ("t", 1)}, TokenTables(words=words, stops_th=stops))
    return out.select("doc_id", T.token_text(F.col("tokens")).alias("tokens"))
