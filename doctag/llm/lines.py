r"""Line dedup by a segment-partition edit join, in DataFrame functions only.

Two lines are linked when at most ``edits`` insertions, deletions or replacements of
code points turn one into the other; lines that links reach are a class, and only the
first occurrence of a class stays. White space around a line does not count. Lines
under ``least`` code points have no near copies; their exact copies are linked from
``shortest`` code points on, and lines under both are left alone. ``line_classes`` and
``op6_lines`` take ``least`` for both, ``without_repeats``, ``op6_lines_short`` and the
pipeline leave out empty lines only.

A line is cut into edits + 1 disjoint segments of a length that depends on its own:
one at its start, one at its end, the others side by side after the first. One
segment of two linked lines is free of edits. The outer ones then stand at the same
place; an inner one is only needed when both outer ones are edited, and has moved by
less than ``edits``. So a line is put under its outer segments and, with every such
shift, its inner ones; lines within ``edits`` of a step of the segment length also
under those of the shorter length. Lines that share a segment are candidates.

Lines under a segment are compared in blocks inside one expression, so that only true
links come out as rows; a pair counts under the smallest segment that it shares. The
common start and end are cut off by bisection. Pairs whose next code points on either
side are already too far apart are dropped; the rest goes through a bit-parallel edit
distance whose words hold a band of 2 edits + 1 diagonals, and ends at the first column
beyond the limit.

Defined cases: null text has no line, an empty text one empty line; a null document
id comes before all others; repeated rows are further occurrences with the same
document id and line number; rows with one document id, or none, and different texts
are different documents, told apart by a hash of the text; an empty table gives an
empty result. Only ``doc_id`` and ``text`` are read; ``without_repeats`` passes other
columns through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from doctag.llm.components import components
from doctag.llm.registry import durable, query, table

EDITS = 2
LEAST = 40
# The shortest line that can be an exact copy: all but empty ones.
SHORTEST = 1
# Segment lengths are multiples of this.
STEP = 4
# Lines of a segment that are compared with each other in one row.
BLOCK = 32
# Common starts and ends of up to 2^21 code points are cut off.
BITS = 20
# Code points on either side of the first and last difference that are looked at first.
GLANCE = 16


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _common(a: Column, b: Column, most: Column, from_end: bool) -> Column:
    """The length of the common start or end, at most ``most``, by bisection."""

    def part(x: Column, done: Column, k: Column) -> Column:
        return F.substr(x, F.length(x) - done - k + 1 if from_end else done + 1, k)

    def step(done: Column, k: Column) -> Column:
        more = (done + k <= most) & (part(a, done, k) == part(b, done, k))
        return F.when(more, done + k).otherwise(done)

    sizes = F.array(*[F.lit(1 << i) for i in range(BITS, -1, -1)])
    return F.aggregate(sizes, F.lit(0), step)


def _band_distance(a: Column, b: Column, edits: int) -> Column:
    """The edit distance of the code points ``a`` and ``b``, where ``a`` is the longer
    by at most ``edits``; more than ``edits`` stands for any distance above.

    The words are the vertical differences of a band around the diagonal, which slides
    down by a row per column; the top bit is the row ``edits`` below it. The distance
    is followed down the lower edge of the band and then along the last row."""
    top = 2 * edits + 1
    mask = (1 << (top + 1)) - 1
    n, m = F.size(a), F.size(b)

    def invert(x: Column) -> Column:
        return F.bitwise_not(x).bitwiseAND(F.lit(mask))

    def update(s: Column, i: Column) -> Column:
        char = F.get(b, i)
        match = F.lit(0)
        for t in range(2 * edits + 1):
            same = F.when(i + edits - t >= 0, F.get(a, i + edits - t) == char)
            match = match + F.when(same, F.lit(1 << (top - t))).otherwise(0)

        def words(x: Column) -> Column:
            carry = (x.bitwiseAND(s["vp"]) + s["vp"]).bitwiseXOR(s["vp"])
            return _let(carry.bitwiseOR(x).bitwiseOR(s["vn"]).bitwiseAND(F.lit(mask)), horizontal)

        def horizontal(d0: Column) -> Column:
            hp = s["vn"].bitwiseOR(invert(d0.bitwiseOR(s["vp"])))
            hn = d0.bitwiseAND(s["vp"])
            return _let(F.struct(d0.alias("d0"), hp.alias("hp"), hn.alias("hn")), following)

        def following(h: Column) -> Column:
            down = F.when(h["d0"].bitwiseAND(F.lit(1 << top)) == 0, 1).otherwise(0)
            bit = F.call_function("shiftleft", F.lit(1), F.lit(top - 1) - (i - (n - edits)))
            along = F.when(h["hp"].bitwiseAND(bit) != 0, 1).otherwise(0) - F.when(
                h["hn"].bitwiseAND(bit) != 0, 1
            ).otherwise(0)
            d = s["d"] + F.when(i < n - edits, down).otherwise(along)
            slid = F.shiftright(h["d0"], 1)
            return F.struct(
                h["hn"].bitwiseOR(invert(slid.bitwiseOR(h["hp"]))).alias("vp"),
                slid.bitwiseAND(h["hp"]).alias("vn"),
                d.alias("d"),
            )

        # Along the last row the distance can still fall, by one a column.
        left = F.when(i < n - edits, F.lit(0)).otherwise(m - i)
        return F.when(s["d"] > F.lit(edits) + F.greatest(left, F.lit(0)) + edits, s).otherwise(_let(match, words))

    start = F.struct(
        F.lit(((1 << (edits + 1)) - 1) << (top - edits)).alias("vp"), F.lit(0).alias("vn"), F.lit(edits).alias("d")
    )
    return F.aggregate(F.sequence(F.lit(0), m - 1), start, update, lambda s: s["d"])


def _ends_alike(a: Column, b: Column, edits: int) -> Column:
    """Where strings are at most ``edits`` apart, starts of equal length are at most twice
    that, and so are ends."""
    starts = F.levenshtein(F.left(a, F.lit(GLANCE)), F.left(b, F.lit(GLANCE)), 2 * edits)
    ends = F.levenshtein(F.right(a, F.lit(GLANCE)), F.right(b, F.lit(GLANCE)), 2 * edits)
    return (starts >= 0) & (ends >= 0)


def within(a: Column, b: Column, edits: int = EDITS) -> Column:
    """True when the strings are at most ``edits`` apart."""

    def bare(c: Column) -> Column:
        """Without the common start, then without the common end."""
        n = F.least(F.length(a), F.length(b))
        tail = _common(a, b, n - c, from_end=True)
        return _let(
            F.struct(
                F.substr(a, c + 1, F.length(a) - c - tail).alias("a"),
                F.substr(b, c + 1, F.length(b) - c - tail).alias("b"),
            ),
            longer,
        )

    def longer(r: Column) -> Column:
        swap = F.length(r["a"]) < F.length(r["b"])
        long, short = F.when(swap, r["b"]).otherwise(r["a"]), F.when(swap, r["a"]).otherwise(r["b"])
        chars = F.struct(F.split(long, "").alias("long"), F.split(short, "").alias("short"))
        distance = _let(chars, lambda x: _band_distance(x["long"], x["short"], edits))
        return (
            F.when(F.greatest(F.length(r["a"]), F.length(r["b"])) <= edits, True)
            .when(F.least(F.length(r["a"]), F.length(r["b"])) == 0, False)
            .when(~_ends_alike(long, short, edits), False)
            .otherwise(distance <= edits)
        )

    near = F.abs(F.length(a) - F.length(b)) <= edits
    whole = _common(a, b, F.least(F.length(a), F.length(b)), from_end=False)
    return F.when(near, _let(whole, bare)).otherwise(False)


def segment_keys(line: Column, edits: int = EDITS) -> Column:
    """Hashes of the segments that a line is found under."""

    def of_size(size: Column) -> Column:
        def key(kind: int, start: Column) -> Column:
            return F.xxhash64(F.lit(kind), size, F.substr(line, start, size))

        outer = [key(0, F.lit(1)), key(1, F.length(line) - size + 1)]
        inner = [
            key(i + 1, size * i + 1 + shift)
            for i in range(1, edits)
            for shift in range(1 - edits, edits)
        ]
        return F.array(*outer, *inner)

    def size(of: Column) -> Column:
        return (F.floor(of / F.lit((edits + 1) * STEP)) * STEP).cast("int")

    own, less = size(F.length(line)), size(F.length(line) - edits)
    return F.array_distinct(
        F.concat(of_size(own), F.when(less < own, of_size(less)).otherwise(F.array().cast("array<bigint>")))
    )


def split_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, line_no, line`` of ``docs(doc_id, text)``, trimmed, from 0."""
    lines = F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")
    return docs.select("doc_id", _hash(F.col("text")).alias("text_hash"), lines).withColumn(
        "line", F.btrim("line", F.lit(" \t\r"))
    )


def _hash(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("x"), F.xxhash64(F.lit(1), line).alias("y"))


def _of_row(rows: DataFrame, known: DataFrame, how: str) -> DataFrame:
    """``rows(doc_id, text)`` with what is ``known`` by ``doc_id, text_hash``: an id may be
    missing or stand on several texts."""
    known = known.withColumnsRenamed({"doc_id": "_doc", "text_hash": "_text_hash"})
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (_hash(F.col("text")) == F.col("_text_hash"))
    return rows.join(known, same, how)


def _links(lines: DataFrame, docs: DataFrame, edits: int) -> DataFrame:
    """``a, b``: the links between distinct ``lines(id, doc_id, line_no, text_hash, keys)``."""
    under = lines.select("id", F.explode("keys").alias("key"))
    several = under.groupBy("key").agg(
        F.count(F.lit(1)).alias("_n"), F.min("id").alias("_low"), F.max("id").alias("_high")
    )
    several = several.filter("_low < _high").select("key", "_n")
    met = durable(under.join(several, "key"))
    # The texts of the candidates, from their first documents.
    wanted = met.select("id").distinct().join(lines, "id")
    places = durable(
        wanted.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("line_no", "id", "keys")).alias("_want"))
    )
    found = _of_row(docs.select("doc_id", "text"), places, "inner")
    texts = found.select(F.split("text", "\n", -1).alias("_lines"), "_want").select("_lines", F.inline("_want"))
    texts = texts.select("id", "keys", F.btrim(F.get("_lines", F.col("line_no")), F.lit(" \t\r")).alias("line"))
    texts = texts.withColumn("n", F.length("line"))
    rows = met.join(texts.dropDuplicates(["id"]), "id")
    count = F.ceil(F.col("_n") / BLOCK).cast("int")
    blocks = durable(
        rows.withColumn("_block", F.pmod(F.xxhash64("id"), count).cast("int"))
        .groupBy("key", "_n", "_block")
        .agg(F.collect_list(F.struct("id", "line", "n", "keys")).alias("lines"))
    )
    other = blocks.select("key", F.col("_block").alias("_other"), F.col("lines").alias("others"))

    def pairs(a: Column, others: Column) -> Column:
        def linked(b: Column) -> Column:
            ordered = (F.col("_block") < F.col("_other")) | (a["id"] < b["id"])
            first = F.array_min(F.array_intersect(a["keys"], b["keys"])) == F.col("key")
            near = F.abs(a["n"] - b["n"]) <= edits
            # Lines that share one end mostly differ at the other, which is seen at once.
            alike = _ends_alike(a["line"], b["line"], edits)
            return F.when(ordered & near & alike, first & within(a["line"], b["line"], edits)).otherwise(False)

        return F.transform(
            F.filter(others, linked), lambda b: F.struct(a["id"].alias("a"), b["id"].alias("b"))
        )

    both = blocks.join(other, "key").filter("_block <= _other")
    return both.select(
        F.inline(F.flatten(F.transform("lines", lambda a: pairs(a, F.col("others")))))
    )


def line_classes(docs: DataFrame, edits: int = EDITS, least: int = LEAST, shortest: int | None = None) -> DataFrame:
    """``doc_id, line_no, class_doc_id, class_line_no, n_links, kept``: every line, the
    first occurrence of its class, and how many other occurrences it is linked with.
    Exact copies are linked from ``shortest`` code points on, or from ``least``."""
    return _classes(docs, edits, least, least if shortest is None else shortest).drop("text_hash")


def _classes(docs: DataFrame, edits: int, least: int, shortest: int) -> DataFrame:
    """``line_classes`` with the ``text_hash`` that tells the rows of one document id apart."""
    line = F.col("line")
    has_near = F.length(line) >= least
    takes_part = has_near | (F.length(line) >= shortest)
    lines = durable(
        split_lines(docs).select(
            "doc_id",
            "line_no",
            "text_hash",
            F.when(takes_part, _hash(line)).alias("hash"),
            F.when(has_near, segment_keys(line, edits)).alias("keys"),
        )
    )
    distinct = durable(
        lines.filter("hash IS NOT NULL")
        .groupBy("hash")
        .agg(
            F.min(F.struct("doc_id", "line_no", "text_hash")).alias("first"),
            F.count(F.lit(1)).alias("copies"),
            F.first("keys").alias("keys"),
        )
        .withColumn("id", F.monotonically_increasing_id())
    )
    links = durable(_links(distinct.select("id", "first.*", "keys"), docs, edits))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    copies = distinct.select(F.col("id").alias("b"), F.col("copies").alias("_c"))
    counts = both.join(copies, "b").groupBy("a").agg(F.sum("_c").alias("_links")).withColumnRenamed("a", "id")
    joined = components(links).withColumnRenamed("node", "id")
    firsts = joined.join(distinct.select("id", "first"), "id").groupBy("component").agg(F.min("first").alias("_class"))
    classes = joined.join(firsts, "component").join(counts, "id").select("id", "_class", "_links")
    # Only lines that occur again or have links need to find their rows.
    known = (
        distinct.join(classes, "id", "left")
        .filter("copies > 1 OR _links IS NOT NULL")
        .select(
            "hash",
            F.coalesce("_class", "first").alias("_first"),
            (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("_n"),
        )
    )
    own = F.struct("doc_id", "line_no", "text_hash")
    first = F.coalesce("_first", own)
    return lines.join(known, "hash", "left").select(
        "doc_id",
        "line_no",
        "text_hash",
        first["doc_id"].alias("class_doc_id"),
        first["line_no"].alias("class_line_no"),
        F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"),
        first.eqNullSafe(own).alias("kept"),
    )


def without_repeats(docs: DataFrame, edits: int = EDITS, least: int = LEAST, shortest: int = SHORTEST) -> DataFrame:
    """``docs`` with the repeated lines taken out of their texts. A document that had
    lines and has lost all of them goes."""
    classes = _classes(docs, edits, least, shortest)
    gone = durable(
        classes.filter(~F.col("kept")).groupBy("doc_id", "text_hash").agg(F.collect_set("line_no").alias("_gone"))
    )
    lines = F.split("text", "\n", -1)
    places = F.sequence(F.lit(0), F.size(lines) - 1)
    left = F.filter(F.arrays_zip(lines.alias("line"), places.alias("at")), lambda x: ~F.array_contains("_gone", x["at"]))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    rows = _of_row(whole.select("_row", "_row.doc_id", "_row.text"), gone, "left").withColumn(
        "_left", F.when(F.col("_gone").isNotNull() & F.col("text").isNotNull(), left)
    )
    text = F.when(F.col("_left").isNull(), F.col("text")).otherwise(F.array_join(F.transform("_left", lambda x: x["line"]), "\n"))
    return (
        rows.filter("_left IS NULL OR size(_left) > 0")
        .withColumn("_row", F.col("_row").withField("text", text))
        .select("_row.*")
    )


SQL = f"""
WITH RECURSIVE pieces AS (
  SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
lines AS (
  SELECT doc_id, (i - 1)::INTEGER AS line_no, trim(ls[i], ' ' || chr(9) || chr(13)) AS line
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM pieces)),
texts AS (
  SELECT line, length(line) AS n, min(row(doc_id, line_no)) AS first, count(*) AS copies,
         row_number() OVER (ORDER BY min(row(doc_id, line_no))) AS id
  FROM lines WHERE length(line) >= {LEAST} GROUP BY line),
lengths AS (SELECT *, unnest(range(n - {EDITS}, n + {EDITS} + 1)) AS m FROM texts),
half AS (
  SELECT a.id AS a, b.id AS b FROM lengths a JOIN texts b ON a.m = b.n AND a.id < b.id
  WHERE levenshtein(a.line, b.line) <= {EDITS}),
links AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reached(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
least_of AS (SELECT a, min(b) AS b FROM reached GROUP BY a),
counts AS (SELECT l.a, sum(t.copies) AS n FROM links l JOIN texts t ON l.b = t.id GROUP BY l.a),
classes AS (
  SELECT t.line, t.copies - 1 + coalesce(c.n, 0) AS n_links, f.first
  FROM texts t LEFT JOIN counts c ON t.id = c.a LEFT JOIN least_of m ON t.id = m.a
  JOIN texts f ON f.id = least(t.id, coalesce(m.b, t.id)))
SELECT l.doc_id, l.line_no,
       CASE WHEN c.line IS NULL THEN l.doc_id ELSE c.first[1] END AS class_doc_id,
       CASE WHEN c.line IS NULL THEN l.line_no ELSE c.first[2] END AS class_line_no,
       coalesce(c.n_links, 0)::BIGINT AS n_links,
       c.line IS NULL OR (c.first[1] = l.doc_id AND c.first[2] = l.line_no) AS kept
FROM lines l LEFT JOIN classes c ON l.line = c.line
"""


@query("op6_lines", SQL)
def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with its class and its links."""
    return line_classes(table(spark, sf_dir, "documents"))


# The same with the exact copies of short lines: these have no links of their own.
SHORT_SQL = SQL.replace(f"WHERE length(line) >= {LEAST} GROUP", f"WHERE length(line) >= {SHORTEST} GROUP").replace(
    "WHERE levenshtein(a.line, b.line)", f"WHERE least(a.n, b.n) >= {LEAST} AND levenshtein(a.line, b.line)"
)


@query("op6_lines_short", SHORT_SQL)
def op6_lines_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with its class and its links, exact copies of short lines included."""
    return line_classes(table(spark, sf_dir, "documents"), shortest=SHORTEST)
