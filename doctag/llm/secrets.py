r"""Secret scan with multipart credential linking, in DataFrame functions only.

Three strong kinds are reported wherever they stand (``assign``, ``access``,
``hex``). Three weak kinds are reported only next to a complementary part:

* ``key``: 40 base64 characters with upper case, lower case and a digit, standing
  alone. Needs an access identifier or an endpoint within the scope.
* ``login``: a user name or client id that is assigned. Needs a secret (``assign``,
  ``hex`` or ``key``) within the scope.
* ``endpoint``: an http(s) address. Needs an access identifier or a login and a
  secret within the scope.

The scope of a candidate reaches ``SCOPE`` code points before its start and
after it. Whether a part lies in it is an interval join: parts are summed up per
document and scope-wide cell (first and last start per kind), and a candidate
meets three cells, so the number of spans in a cell does not matter.

Positions are code points, ends exclusive. A pattern's spans follow from the
lengths of its matches and of the text between them.

Defined cases: null text is empty; empty texts have no spans; a null document id
and repeated rows are rows of their own; ties in start order by kind as listed in
``KINDS``; an empty table gives an empty result. Other columns of the documents
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from doctag.llm.registry import durable, query, table

# Patterns in the common part of Java and RE2 syntax; case is written out.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# A maximal run of base64 characters; runs of other lengths are dropped later.
KEY_RUN = r"[A-Za-z0-9+/]{40,}"
LOGIN = (
    r"\b(?:[Uu][Ss][Ee][Rr](?:[_-]?[Nn][Aa][Mm][Ee]|[_-]?[Ii][Dd])?|[Ll][Oo][Gg][Ii][Nn]"
    r"|[Cc][Ll][Ii][Ee][Nn][Tt][_-]?[Ii][Dd])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.@-]+)"
)
ENDPOINT = r"https?://[^\x20\x09-\x0D\"'<>]+"

KINDS = ("assign", "access", "hex", "key", "login", "endpoint")
BASE = KINDS[:3]
SCOPE = 300
MIN_ASSIGNED = 6
KEY_LENGTH = 40


def _spans(text: Column, pattern: str, kind: str, keep) -> Column:
    """``array<struct<start, kind, end>>`` of the matches for which ``keep`` of
    match and second group holds."""
    rx = F.lit(pattern)
    groups = 2 if pattern == ASSIGN else 0
    found = F.regexp_extract_all(text, rx, F.lit(0))
    second = F.regexp_extract_all(text, rx, F.lit(groups))
    between = F.split(text, pattern, -1)
    rank = F.lit(KINDS.index(kind))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = start + F.length(x["all"])
        span = F.struct(start.alias("start"), rank.alias("kind"), end.alias("end"))
        kept = F.when(keep(x["all"], x["part"]), F.array(span)).otherwise(F.array().cast(ARRAY))
        return F.struct(end.alias("at"), F.concat(state["spans"], kept).alias("spans"))

    zipped = F.arrays_zip(between.alias("gap"), found.alias("all"), second.alias("part"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(ARRAY).alias("spans"))
    # The last gap has no match: it is cut off.
    matches = F.slice(zipped, 1, F.greatest(F.size(found), F.lit(0)))
    return F.when(
        text.rlike(pattern), F.aggregate(matches, start, step, lambda s: s["spans"])
    ).otherwise(F.array().cast(ARRAY))


ARRAY = "array<struct<start:int,kind:int,end:int>>"


def found_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, base, weak``: the spans of every row of ``docs(doc_id, text)``,
    both in order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    always = lambda m, p: F.lit(True)
    key = lambda m, p: (
        (F.length(m) == KEY_LENGTH) & m.rlike("[A-Z]") & m.rlike("[a-z]") & m.rlike("[0-9]")
    )
    base = F.concat(
        _spans(text, ASSIGN, "assign", lambda m, p: F.length(p) >= MIN_ASSIGNED),
        _spans(text, ACCESS, "access", always),
        _spans(text, HEX, "hex", always),
    )
    weak = F.concat(
        _spans(text, KEY_RUN, "key", key),
        _spans(text, LOGIN, "login", always),
        _spans(text, ENDPOINT, "endpoint", always),
    )
    return docs.select("doc_id", F.array_sort(base).alias("base"), F.array_sort(weak).alias("weak"))


def _within(cells: DataFrame, weak: DataFrame) -> DataFrame:
    """``_row, spans``: the weak spans that have what they need in their scope."""
    near = F.explode(F.array(*[F.col("_cell") + d for d in (-1, 0, 1)]))
    met = weak.withColumn("_at", near).join(
        cells.withColumnRenamed("_cell", "_at"), ["_row", "_at"]
    )

    def has(kind: str) -> Column:
        first, last = F.col(f"first_{kind}"), F.col(f"last_{kind}")
        start = F.col("start")
        # The nearest starts on either side of a cell decide; in the candidate's
        # own cell every start is in scope.
        hit = F.when(F.col("_at") == F.col("_cell"), first.isNotNull()).otherwise(
            F.when(F.col("_at") < F.col("_cell"), last >= start - SCOPE).otherwise(
                first <= start + SCOPE
            )
        )
        return F.max(F.coalesce(hit, F.lit(False))).alias(kind)

    seen = met.groupBy("_row", "start", "kind", "end").agg(*[has(k) for k in KINDS])
    secret = F.col("assign") | F.col("hex") | F.col("key")
    rule = {
        "key": F.col("access") | F.col("endpoint"),
        "login": secret,
        "endpoint": F.col("access") | (F.col("login") & secret),
    }
    wanted = F.lit(False)
    for kind, need in rule.items():
        wanted = wanted | ((F.col("kind") == KINDS.index(kind)) & need)
    return (
        seen.filter(wanted)
        .groupBy("_row")
        .agg(F.collect_list(F.struct("start", "kind", "end")).alias("linked"))
    )


def linked_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, base, spans`` with ``array<struct<start, kind, end>>`` columns, a
    row per row of ``docs``. The texts are read once; the spans, a small part of
    them, are stored, which also gives every row a lasting number."""
    rows = durable(found_spans(docs)).withColumn("_row", F.monotonically_increasing_id())
    some = rows.filter(F.size("weak") > 0)
    cell = F.floor(F.col("start") / SCOPE)
    each = lambda c: some.select("_row", F.inline(c)).withColumn("_cell", cell)
    weak = each("weak")
    parts = weak.unionByName(each("base"))
    cells = parts.groupBy("_row", "_cell").agg(
        *[
            agg(F.when(F.col("kind") == i, F.col("start"))).alias(f"{side}_{kind}")
            for i, kind in enumerate(KINDS)
            for side, agg in (("first", F.min), ("last", F.max))
        ]
    )
    linked = F.coalesce(F.col("linked"), F.array().cast(ARRAY))
    return rows.join(_within(cells, weak), "_row", "left").select(
        "doc_id", "base", F.array_sort(F.concat("base", linked)).alias("spans")
    )


def joined(spans: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def _sql_spans(name: str, pattern: str, kind: str, keep: str = "true", second: int = 0) -> str:
    rx = pattern.replace("'", "''")
    return f"""
{name}_m AS (SELECT row_id, regexp_extract_all(t, '{rx}') AS m, regexp_extract_all(t, '{rx}', {second}) AS p,
   string_split_regex(t, '{rx}') AS gap FROM docs WHERE regexp_matches(t, '{rx}')),
{name}_u AS (SELECT row_id, unnest(range(1, len(m) + 1)) AS i, m, p, gap FROM {name}_m),
{name}_s AS (SELECT row_id, m[i] AS a, p[i] AS b,
   (list_sum(list_transform(gap[1:i], lambda x: length(x)))
    + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s FROM {name}_u),
{name} AS (SELECT row_id, s, {KINDS.index(kind)} AS k, s + length(a) AS e FROM {name}_s WHERE {keep})"""


SQL = (
    "WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS t FROM documents),"
    + ",".join(
        [
            _sql_spans("a", ASSIGN, "assign", f"length(b) >= {MIN_ASSIGNED}", 2),
            _sql_spans("c", ACCESS, "access"),
            _sql_spans("h", HEX, "hex"),
            _sql_spans(
                "y", KEY_RUN, "key",
                f"length(a) = {KEY_LENGTH} AND regexp_matches(a, '[A-Z]') AND regexp_matches(a, '[a-z]')"
                " AND regexp_matches(a, '[0-9]')",
            ),
            _sql_spans("l", LOGIN, "login"),
            _sql_spans("p", ENDPOINT, "endpoint"),
        ]
    )
    + f""",
base AS (SELECT * FROM a UNION ALL SELECT * FROM c UNION ALL SELECT * FROM h),
weak AS (SELECT * FROM y UNION ALL SELECT * FROM l UNION ALL SELECT * FROM p),
parts AS (SELECT * FROM base UNION ALL SELECT * FROM weak),
met AS (SELECT w.row_id, w.s, w.k, w.e,
   bool_or(q.k = 1) AS has_access, bool_or(q.k IN (0, 2, 3)) AS has_secret,
   bool_or(q.k = 4) AS has_login, bool_or(q.k = 5) AS has_endpoint
  FROM weak w JOIN parts q ON w.row_id = q.row_id
   AND (abs(q.s - w.s) <= {SCOPE} OR q.s // {SCOPE} = w.s // {SCOPE})
  GROUP BY ALL),
linked AS (SELECT row_id, s, k, e FROM met WHERE
   (k = 3 AND (has_access OR has_endpoint)) OR (k = 4 AND has_secret)
   OR (k = 5 AND (has_access OR (has_login AND has_secret)))),
spans AS (SELECT *, true AS is_base FROM base UNION ALL SELECT *, false FROM linked),
named AS (SELECT *, {list(KINDS)!r}[k + 1] || ':' || s || ':' || e AS span FROM spans)
SELECT d.doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access,
  count(*) FILTER (k = 2) AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY s, k, e) FILTER (is_base), '')) AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY s, k, e), '') AS spans
FROM docs d LEFT JOIN named n ON d.row_id = n.row_id GROUP BY d.row_id, d.doc_id
"""
)


@query("op9_secrets", SQL)
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its secrets."""
    rows = linked_spans(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        n = F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind)))
        return n.cast("long").alias(f"n_{kind}")

    return rows.select(
        "doc_id",
        *[count(k) for k in BASE],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
