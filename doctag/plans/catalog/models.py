"""Spark ML classifiers, sources and sinks."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from doctag.functions.clean import drop_illegal
from doctag.functions.tokens import term_counts
from doctag.operators import least_squares, many_bayes
from doctag.operators import metrics as M
from doctag.operators import trees
from doctag.operators.lemmas import join_small_or_salted
from doctag.operators.sampling import split_exact
from doctag.plans import training as P
from doctag.plans.catalog.features import (
    BALANCED,
    BAYES,
    fitted,
    fitted_once,
    segmented_once,
    tfidf_ctes,
    train_set,
    weighted_once,
)
from doctag.plans.catalog.rules import HITS, VERDICT
from doctag.plans.catalog.registry import (
    DOCS,
    LABELLED,
    TAGGED,
    docs,
    labelled_docs,
    query,
    table,
    tagged_docs,
    with_,
)
from doctag.session import durable, scratch_path
from doctag.sources import documents as D
from doctag.sources.lists import read_charset, read_word_table


def vectors(spark, sf, predicts=True):
    """Balanced training rows as vectors, and all documents as vectors. The vocabulary
    is that of the whole corpus. Only a query that ``predicts`` stores all of them."""
    model, seg = fitted_once(docs(spark, sf))
    # The tokens are longer than the vectors, which are made once, where the rows lie.
    rows = P.vectorize(seg, P.vectorizer(model, arrays=True)).select("doc_id", "features")
    rows = durable(rows, "zstd") if predicts else rows
    return training_rows(spark, sf, rows), rows


def training_rows(spark, sf, rows):
    """The balanced training rows with their tags, stored. The tags go to the vectors."""
    tags = train_set(spark, sf).select("doc_id", "tag")
    return durable(join_small_or_salted(rows, tags, ["doc_id"], "inner", "doc_id"), "zstd")


def bayes_sql(select: str) -> str:
    return with_(DOCS, LABELLED, BALANCED, BAYES, select=select)


# Several models at once: ``parts(s, doc_id, tag, side)`` says which balanced rows model
# s is fitted on (side 'fit') and which it judges (any other side).
SEVERAL = ",\n".join(
    [
        "cws AS (SELECT s, field, term, sum(CASE WHEN tag = '!0' THEN weight ELSE 0 END) AS a,"
        " sum(CASE WHEN tag = '0' THEN weight ELSE 0 END) AS b FROM w JOIN parts ON w.doc_id = parts.doc_id"
        " WHERE side = 'fit' GROUP BY s, field, term)",
        "sets AS (SELECT s, ln(count(*) FILTER (tag = '!0') + 1) AS pa, ln(count(*) FILTER (tag = '0') + 1) AS pb"
        " FROM parts WHERE side = 'fit' GROUP BY s)",
        "denses AS (SELECT sets.s, idf.field, idf.term, coalesce(a, 0) AS a, coalesce(b, 0) AS b FROM sets CROSS JOIN idf"
        " LEFT JOIN cws ON sets.s = cws.s AND idf.field = cws.field AND idf.term = cws.term)",
        "tots AS (SELECT s, sum(a) AS a, sum(b) AS b, count(*) AS n FROM denses GROUP BY s)",
        "lps AS (SELECT d.s, field, term, ln(d.a + 1) - ln(t.a + t.n) AS a, ln(d.b + 1) - ln(t.b + t.n) AS b"
        " FROM denses d JOIN tots t ON d.s = t.s)",
        "scs AS (SELECT p.s, p.side, p.doc_id, sum(weight * lps.a) AS a, sum(weight * lps.b) AS b FROM parts p"
        " JOIN w ON p.doc_id = w.doc_id JOIN lps ON lps.s = p.s AND lps.field = w.field AND lps.term = w.term"
        " WHERE p.side <> 'fit' GROUP BY p.s, p.side, p.doc_id)",
        "verdicts AS (SELECT p.s, p.side, p.tag, CASE WHEN pa + coalesce(c.a, 0) >= pb + coalesce(c.b, 0) THEN '!0'"
        " ELSE '0' END AS predict FROM parts p JOIN sets ON p.s = sets.s"
        " LEFT JOIN scs c ON p.s = c.s AND p.side = c.side AND p.doc_id = c.doc_id WHERE p.side <> 'fit')",
        "occur AS (SELECT s, side, tag AS label FROM verdicts UNION SELECT s, side, predict FROM verdicts)",
        "sums AS (SELECT o.s, o.side, o.label, count(*) FILTER (v.tag = o.label AND v.predict = o.label) AS hit,"
        " count(*) FILTER (v.predict = o.label) AS said, count(*) FILTER (v.tag = o.label) AS support"
        " FROM occur o JOIN verdicts v ON o.s = v.s AND o.side = v.side GROUP BY o.s, o.side, o.label)",
        "ratios AS (SELECT *, CASE WHEN said > 0 THEN hit / said ELSE 0.0 END AS p,"
        " CASE WHEN support > 0 THEN hit / support ELSE 0.0 END AS r, 2 * hit / (said + support) AS f FROM sums)",
        "f1s AS (SELECT s, side, avg(f) AS f1 FROM ratios GROUP BY s, side)",
    ]
)


def several_sql(parts: str, select: str) -> str:
    return with_(DOCS, LABELLED, BALANCED, BAYES, parts, SEVERAL, select=select)


def folds_sql(k: int) -> str:
    cuts = " + ".join(f"(r > floor(n * {j} / CAST({k} AS DOUBLE)))::INT" for j in range(1, k))
    return (
        "ranks AS (SELECT doc_id, tag, row_number() OVER (PARTITION BY tag ORDER BY md5('0:' || CAST(doc_id AS VARCHAR))) AS r,"
        f" count(*) OVER (PARTITION BY tag) AS n FROM train), folds AS (SELECT doc_id, tag, {cuts} AS fold FROM ranks),"
        " parts AS (SELECT s.fold AS s, f.doc_id, f.tag, CASE WHEN f.fold = s.fold THEN 'judge' ELSE 'fit' END AS side"
        " FROM folds f CROSS JOIN (SELECT DISTINCT fold FROM folds) s)"
    )


HOLD_OUT = (
    "ranks AS (SELECT doc_id, tag, row_number() OVER (ORDER BY md5('5:' || CAST(doc_id AS VARCHAR))) AS r,"
    " count(*) OVER () AS n FROM train), parts AS ("
    "SELECT 'in_sample' AS s, doc_id, tag, side FROM train CROSS JOIN (VALUES ('fit'), ('judge')) v(side)"
    " UNION ALL SELECT 'hold_out', doc_id, tag, CASE WHEN r > ceil(n * CAST(0.3 AS DOUBLE)) THEN 'fit' ELSE 'judge' END FROM ranks)"
)
CURVE = (
    "splits AS (SELECT split, doc_id, tag, row_number() OVER (PARTITION BY split ORDER BY md5(split || ':' || CAST(doc_id AS VARCHAR))) AS r,"
    " count(*) OVER (PARTITION BY split) AS n FROM train CROSS JOIN range(100) t(split)),"
    " kept AS (SELECT split, doc_id, tag, row_number() OVER (PARTITION BY split ORDER BY md5(split || '/size:' || CAST(doc_id AS VARCHAR))) AS r,"
    " count(*) OVER (PARTITION BY split) AS n FROM splits WHERE r > ceil(n * CAST(0.2 AS DOUBLE))),"
    " sizes AS (SELECT unnest([0.2, 0.4, 0.6, 0.8, 1.0])::DOUBLE AS size),"
    " parts AS (SELECT {s: split, size: size} AS s, doc_id, tag, side FROM kept CROSS JOIN sizes"
    " CROSS JOIN (VALUES ('fit'), ('train')) v(side) WHERE r <= floor(n * size)"
    " UNION ALL SELECT {s: split, size: size}, doc_id, tag, 'valid' FROM splits CROSS JOIN sizes"
    " WHERE r <= ceil(n * CAST(0.2 AS DOUBLE)))"
)


@query(
    "vector_blocks",
    "L4 L5 J2 M9",
    bayes_sql(
        "SELECT t.doc_id, (SELECT count(*) FROM idf)::INTEGER AS size, count(w.term)::INTEGER AS used,"
        " round(coalesce(sum(weight * weight), 0), 6) AS square FROM train t LEFT JOIN w ON t.doc_id = w.doc_id GROUP BY t.doc_id"
    ),
)
def vector_blocks(spark, sf):
    train, _ = vectors(spark, sf, predicts=False)
    from pyspark.ml.functions import vector_to_array

    values = vector_to_array("features")
    used = F.filter(values, lambda x: x > 0)
    return train.select(
        "doc_id",
        F.size(values).alias("size"),
        F.size(used).alias("used"),
        F.round(F.aggregate(used, F.lit(0.0), lambda a, x: a + x * x), 6).alias("square"),
    )


@query(
    "bayes_classifier",
    "L6 L8 X3",
    with_(
        DOCS,
        LABELLED,
        BALANCED,
        BAYES,
        select="SELECT doc_id, predict FROM judged",
    ),
)
def bayes_classifier(spark, sf):
    train, rows = vectors(spark, sf)
    return P.predict(P.fit(train, "bayes"), rows).select("doc_id", "predict")


@query(
    "bayes_term_table",
    "L15 J9",
    with_(
        DOCS,
        LABELLED,
        BALANCED,
        BAYES,
        select="SELECT '!0' AS class, field, term, round(a, 6) AS logp FROM lp"
        " UNION ALL SELECT '0', field, term, round(b, 6) FROM lp",
    ),
)
def bayes_term_table(spark, sf):
    model, seg = fitted_once(docs(spark, sf))
    stages = P.vectorizer(model, arrays=True)
    train = training_rows(spark, sf, P.vectorize(seg, stages).select("doc_id", "features"))
    model = P.fit(train, "bayes")
    out = P.term_log_probability(spark, model, stages)
    return out.withColumn("logp", F.round("logp", 6))


@query(
    "bayes_with_thresholds",
    "L7",
    bayes_sql("SELECT doc_id, CASE WHEN (1 - p) / 0.3 >= p / 0.7 THEN '!0' ELSE '0' END AS predict FROM judged"),
)
def bayes_with_thresholds(spark, sf):
    train, rows = vectors(spark, sf)
    model = P.fit_thresholds(train, {"0": 0.7, "!0": 0.3})
    return P.predict(model, rows).select("doc_id", "predict")


@query(
    "bayes_with_cutoff",
    "F17 L7 X4",
    bayes_sql("SELECT doc_id, CASE WHEN p > 0.3 THEN '1' ELSE '0' END AS predict FROM judged"),
)
def bayes_with_cutoff(spark, sf):
    train, rows = vectors(spark, sf)
    scored = P.predict(P.fit(train, "bayes"), rows, scores=True)
    return P.cutoff(scored, F.get("probability", F.lit(1)), 0.3).select("doc_id", "predict")


@query("tree_classifier", "L9")
def tree_classifier(spark, sf):
    train, rows = vectors(spark, sf)
    return P.predict(P.fit(train, "tree"), rows).select("doc_id", "predict")


# A tree over long-form weights, grown by the same rule: level l has the rows of ``at{l}``.
def tree_sql(depth: int) -> list[str]:
    out = [
        "steps AS (SELECT doc_id, field, term, CAST(ceil(round(weight * 32, 6)) AS INTEGER) AS step FROM w WHERE weight > 0)",
        "at0 AS (SELECT doc_id, 1::BIGINT AS node FROM docs)",
    ]
    for level in range(depth):
        gain = " + ".join(
            f"coalesce(({a} * {a} + {b} * {b}) / nullif({a} + {b}, 0), NULL)" for a, b in (("ra", "rb"), ("(a - ra)", "(b - rb)"))
        )
        out += [
            f"of{level} AS (SELECT at{level}.doc_id, node, (tag = '!0')::INT AS a, (tag = '0')::INT AS b FROM at{level}"
            f" JOIN train ON at{level}.doc_id = train.doc_id WHERE node >= {2**level})",
            f"total{level} AS (SELECT node, sum(a)::DOUBLE AS a, sum(b)::DOUBLE AS b FROM of{level} GROUP BY node)",
            f"seen{level} AS (SELECT node, field, term, step, sum(a) AS a, sum(b) AS b FROM of{level}"
            f" JOIN steps ON of{level}.doc_id = steps.doc_id GROUP BY node, field, term, step)",
            f"above{level} AS (SELECT node, field, term, step, sum(a) OVER s AS ra, sum(b) OVER s AS rb FROM seen{level}"
            " WINDOW s AS (PARTITION BY node, field, term ORDER BY step DESC))",
            f"gains{level} AS (SELECT r.node, field, term, step, a, b,"
            f" round(({gain} - (a * a + b * b) / (a + b)) / (a + b), 12) AS gain FROM above{level} r JOIN total{level} t ON r.node = t.node)",
            f"split{level} AS (SELECT * FROM gains{level} WHERE gain > 0"
            " QUALIFY row_number() OVER (PARTITION BY node ORDER BY gains%d.gain DESC, field, term, step) = 1)" % level,
            f"at{level + 1} AS (SELECT at{level}.doc_id, CASE WHEN p.node IS NULL THEN at{level}.node"
            f" ELSE 2 * at{level}.node + (s.step IS NOT NULL)::INT END AS node FROM at{level} LEFT JOIN split{level} p ON at{level}.node = p.node"
            f" LEFT JOIN steps s ON at{level}.doc_id = s.doc_id AND s.field = p.field AND s.term = p.term AND s.step >= p.step)",
        ]
    return out


def long_tree(spark, sf, depth):
    _, weights = weighted_once(docs(spark, sf))
    tags = train_set(spark, sf).select("doc_id", "tag")
    rows = durable(trees.term_rows(weights, docs(spark, sf).select("doc_id"), "doc_id").join(tags, "doc_id", "left"))
    return rows, trees.fit_tree(rows, "tag", ("!0", "0"), depth)


@query(
    "tree_of_terms",
    "L9",
    with_(
        DOCS,
        LABELLED,
        BALANCED,
        tfidf_ctes(),
        *tree_sql(2),
        "leaves AS (SELECT at2.node, sum((tag = '!0')::INT) AS a, sum((tag = '0')::INT) AS b FROM at2"
        " JOIN train ON at2.doc_id = train.doc_id GROUP BY at2.node)",
        select="SELECT doc_id, CASE WHEN a >= b THEN '!0' ELSE '0' END AS predict FROM at2 LEFT JOIN leaves ON at2.node = leaves.node",
    ),
)
def tree_of_terms(spark, sf):
    """Predictions of a tree of depth 2 for all documents."""
    rows, tree = long_tree(spark, sf, 2)
    return trees.predict_tree(rows.drop("tag"), tree).select("doc_id", "predict")


@query(
    "tree_splits",
    "L9",
    with_(
        DOCS,
        LABELLED,
        BALANCED,
        tfidf_ctes(),
        *tree_sql(4),
        select=" UNION ALL ".join(
            "SELECT node, field, term, step, a::BIGINT AS not_zero, b::BIGINT AS zero, round(gain, 9) AS gain"
            f" FROM split{level}" for level in range(4)
        ),
    ),
)
def tree_splits(spark, sf):
    """All splits of a tree of depth 4, with the documents of either class that they meet."""
    nodes = long_tree(spark, sf, 4)[1].nodes.filter("term IS NOT NULL")
    counts = [F.get("counts", F.lit(i)).alias(n) for i, n in enumerate(("not_zero", "zero"))]
    return nodes.select("node", "field", "term", "step", *counts, F.round("gain", 9).alias("gain"))


@query("linear_svc_classifier", "L10")
def linear_svc_classifier(spark, sf):
    train, rows = vectors(spark, sf)
    return P.predict(P.fit(train, "svc"), rows).select("doc_id", "predict")


@query("linear_score_classifier", "L11 F18")
def linear_score_classifier(spark, sf):
    train, rows = vectors(spark, sf)
    model = P.fit(train, "linear", regParam=0.1, solver="l-bfgs")
    return P.predict(model, rows).select("doc_id", "predict")


@query(
    "linear_score_on_one_feature",
    "L11 F18",
    """WITH x AS (SELECT d.doc_id, n_chars::DOUBLE AS x, quality::DOUBLE AS y
                  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
            line AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM x WHERE y IS NOT NULL)
       SELECT doc_id, CASE WHEN a + b * x > 0.5 THEN '1' ELSE '0' END AS predict FROM x, line""",
)
def linear_score_on_one_feature(spark, sf):
    """The linear score with the length of a document as its only feature."""
    rows = table(spark, sf, "documents").select("doc_id", F.array(F.col("n_chars").cast("double")).alias("x"))
    rows = rows.select("doc_id", array_to_vector("x").alias("features"))
    tags = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("tag"))
    model = P.fit(rows.join(tags, "doc_id"), "linear", solver="normal")
    return P.predict(model, rows).select("doc_id", "predict")


@query(
    "least_squares_residuals",
    "L11",
    with_(
        DOCS,
        LABELLED,
        BALANCED,
        tfidf_ctes(),
        select="SELECT DISTINCT field, term, 0.0::DOUBLE AS residual FROM w JOIN train ON w.doc_id = train.doc_id"
        " UNION ALL SELECT '', '', 0.0::DOUBLE",
    ),
)
def least_squares_residuals(spark, sf):
    """What a linear score over all terms leaves of each normal equation: nothing."""
    _, weights = weighted_once(docs(spark, sf))
    labels = train_set(spark, sf).select("doc_id", (F.col("tag") == "0").cast("int").alias("y"))
    model = least_squares.fit_least_squares(weights, labels, "doc_id", "y", penalty=0.1)
    return model.terms.select("field", "term", F.abs(F.round("residual", 6)).alias("residual"))


# Means, products about them, and Cramer's rule for three columns.
COLUMNS3 = (
    "x AS (SELECT d.doc_id, n_chars::DOUBLE AS a, (length(text) - length(replace(text, ' ', '')))::DOUBLE AS b,"
    " (length(text) - length(replace(text, 'e', '')))::DOUBLE AS c, quality::DOUBLE AS z"
    " FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
)
CRAMER = ",\n".join(
    [
        "k AS (SELECT avg(a) AS a, avg(b) AS b, avg(c) AS c, avg(z) AS z FROM x WHERE z IS NOT NULL)",
        "s AS (SELECT "
        + ", ".join(
            f"sum((x.{p} - k.{p}) * (x.{q} - k.{q})) AS {p}{q}" for p, q in ("aa", "ab", "ac", "bb", "bc", "cc", "az", "bz", "cz")
        )
        + " FROM x CROSS JOIN k WHERE x.z IS NOT NULL)",
        "d AS (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det FROM s)",
        "beta AS (SELECT (az * (bb * cc - bc * bc) - ab * (bz * cc - bc * cz) + ac * (bz * bc - bb * cz)) / det AS a,"
        " (aa * (bz * cc - bc * cz) - az * (ab * cc - bc * ac) + ac * (ab * cz - bz * ac)) / det AS b,"
        " (aa * (bb * cz - bz * bc) - ab * (ab * cz - bz * ac) + az * (ab * bc - bb * ac)) / det AS c FROM d)",
    ]
)


@query(
    "least_squares_on_three_columns",
    "L11 F18",
    with_(
        COLUMNS3,
        CRAMER,
        select="SELECT doc_id, round(k.z + beta.a * (x.a - k.a) + beta.b * (x.b - k.b) + beta.c * (x.c - k.c), 6) AS score"
        " FROM x CROSS JOIN k CROSS JOIN beta",
    ),
)
def least_squares_on_three_columns(spark, sf):
    """A linear score of the lengths, spaces and letters e of a document, as three terms."""
    rows = table(spark, sf, "documents").select("doc_id", "n_chars", "text")
    count = lambda c: F.length("text") - F.length(F.replace("text", F.lit(c), F.lit("")))
    named = {"chars": F.col("n_chars"), "spaces": count(" "), "letters": count("e")}
    each = F.array(*[F.struct(F.lit("x").alias("field"), F.lit(n).alias("term"), c.cast("double").alias("weight")) for n, c in named.items()])
    weights = durable(rows.select("doc_id", F.inline(each)))
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    model = least_squares.fit_least_squares(weights, labels, "doc_id", "quality", tolerance=1e-12)
    out = least_squares.predict_least_squares(weights, rows.select("doc_id"), model, "doc_id")
    return out.select("doc_id", F.round("score", 6).alias("score"))


@query("side_by_side_predictions", "F11")
def side_by_side_predictions(spark, sf):
    train, rows = vectors(spark, sf)
    models = {"it_pred": P.fit(train, "bayes"), "stem_pred": P.fit(train, "svc")}
    return P.predict_all(models, rows).select("doc_id", "it_pred", "stem_pred")


@query(
    "side_by_side_cutoffs",
    "F11 F17",
    bayes_sql(
        "SELECT doc_id, predict AS it_pred, CASE WHEN (1 - p) / 0.1 >= p / 0.9 THEN '!0' ELSE '0' END AS stem_pred"
        " FROM judged"
    ),
)
def side_by_side_cutoffs(spark, sf):
    train, rows = vectors(spark, sf)
    models = {"it_pred": P.fit(train, "bayes"), "stem_pred": P.fit_thresholds(train, {"0": 0.9, "!0": 0.1})}
    return P.predict_all(models, rows).select("doc_id", "it_pred", "stem_pred")


@query(
    "listed_mistakes",
    "L14 F6",
    bayes_sql(
        "SELECT l.doc_id, CASE WHEN tag = '0' THEN '0' ELSE '!0' END AS tag, predict FROM labelled l JOIN judged j"
        " ON l.doc_id = j.doc_id WHERE predict <> CASE WHEN tag = '0' THEN '0' ELSE '!0' END"
    ),
)
def listed_mistakes(spark, sf):
    from doctag.operators.dataset import mispredicted, one_vs_rest

    train, rows = vectors(spark, sf)
    tags = one_vs_rest(labelled_docs(spark, sf).select("doc_id", "tag"), "0")
    done = P.predict(P.fit(train, "bayes"), rows.join(tags, "doc_id"))
    return mispredicted(done).select("doc_id", "tag", "predict")


@query(
    "cross_validation",
    "L12 A8 W13 M11",
    several_sql(folds_sql(6), "SELECT s AS fold, round(f1, 6) AS macro_f1 FROM f1s"),
)
def cross_validation(spark, sf):
    train, _ = vectors(spark, sf, predicts=False)
    scores = P.cross_val_f1(train, "bayes", "doc_id", 6)
    return scores.withColumn("macro_f1", F.round("macro_f1", 6))


@query(
    "cross_validated_scores",
    "A9 L12",
    several_sql(
        folds_sql(3),
        "SELECT 'bayes' AS kind, round(avg(f1), 6) AS macro_f1_mean, round(stddev_pop(f1), 6) AS macro_f1_std FROM f1s",
    ),
)
def cross_validated_scores(spark, sf):
    train, _ = vectors(spark, sf, predicts=False)
    scores = P.cross_val_f1(train, "bayes", "doc_id", 3).withColumn("kind", F.lit("bayes"))
    out = M.score_summary(scores, ["kind"], ["macro_f1"])
    return out.withColumns({c: F.round(c, 6) for c in ("macro_f1_mean", "macro_f1_std")})


@query(
    "learning_curve",
    "L13 W14 M11",
    several_sql(
        CURVE,
        "SELECT s.size AS train_fraction, s.s::INTEGER AS split, round(max(f1) FILTER (side = 'train'), 6) AS train_score,"
        " round(max(f1) FILTER (side = 'valid'), 6) AS valid_score FROM f1s GROUP BY s",
    ),
)
def learning_curve(spark, sf):
    """Five sizes in 100 splits."""
    model, weights = weighted_once(docs(spark, sf))
    labels = durable(train_set(spark, sf).select("doc_id", "tag"))
    curve = many_bayes.learning_curve(weights, labels, model.terms.count(), "doc_id", splits=100)
    return curve.withColumns({c: F.round(c, 6) for c in ("train_score", "valid_score")})


@query(
    "evaluation_in_and_out",
    "L16 A7",
    several_sql(
        HOLD_OUT,
        'SELECT s AS sample, label, round(p, 6) AS "precision", round(r, 6) AS recall, round(f, 6) AS f1, support FROM ratios'
        " UNION ALL SELECT s, 'avg / total', round(sum(p * support) / sum(support), 6),"
        " round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6),"
        " CAST(sum(support) AS BIGINT) FROM ratios GROUP BY s",
    ),
)
def evaluation_in_and_out(spark, sf):
    train, _ = vectors(spark, sf, predicts=False)
    out = P.evaluate_split(train, "bayes", "doc_id", 0.3, 5)
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query("reloaded_classifier", "S10 L8", bayes_sql("SELECT doc_id, predict FROM judged"))
def reloaded_classifier(spark, sf):
    seg, _ = segmented_once(docs(spark, sf), arrays=True)
    stages = P.vectorizer(fitted(seg), arrays=True)
    base = scratch_path(spark, "models")
    P.save_model(stages, f"{base}/vectors")
    train = training_rows(spark, sf, P.vectorize(seg, stages).select("doc_id", "features"))
    P.save_model(P.fit(train, "bayes"), f"{base}/bayes")
    again = P.vectorize(seg, P.load_model(f"{base}/vectors")).select("doc_id", "features")
    return P.predict(P.load_model(f"{base}/bayes"), again).select("doc_id", "predict")


@query("held_out_rows", "W12 L16", "SELECT doc_id, quality FROM labels ORDER BY md5('5:' || CAST(doc_id AS VARCHAR)) LIMIT (SELECT CAST(ceil(count(*) * CAST(0.3 AS DOUBLE)) AS BIGINT) FROM labels)")
def held_out_rows(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return split_exact(labels, "doc_id", 0.3, 5)[1]


# --- sources and sinks: written to the shared folder and read back -------------------

RAW_SQL = with_(DOCS, TAGGED, select='SELECT title, body AS "desc", tag FROM tagged')


def raw(spark, sf):
    return tagged_docs(spark, sf).select("title", "desc", "tag")


@query("json_lines", "S1 S6 M1", RAW_SQL)
def json_lines(spark, sf):
    path = scratch_path(spark, "lines")
    D.write_json_records(raw(spark, sf), path)
    return D.read_json_lines(spark, path)


@query("json_arrays", "S2", RAW_SQL)
def json_arrays(spark, sf):
    # A file is one list, here of the documents with neighbouring keys: at most
    # 500 of them, since the key is unique.
    path = scratch_path(spark, "arrays")
    fields = F.collect_list(F.struct("title", "desc", "tag"))
    bundles = tagged_docs(spark, sf).groupBy(F.expr("doc_id div 500").alias("bundle")).agg(
        F.to_json(fields, {"ignoreNullFields": "false"}).alias("list")
    )
    bundles.select("list").write.option("maxRecordsPerFile", 1).text(path)
    return D.read_json_array(spark, path).select("title", "desc", "tag")


@query("json_list_files", "S2", RAW_SQL)
def json_list_files(spark, sf):
    """All documents in lists of up to 100,000, a file each, whose splits go to different tasks."""
    path = scratch_path(spark, "lists")
    rows = tagged_docs(spark, sf).withColumn("list", F.expr("doc_id div 100000"))
    order = W.partitionBy("list").orderBy("doc_id")
    record = F.to_json(F.struct("title", "desc", "tag"), {"ignoreNullFields": "false"})
    mark = F.when(F.lag("doc_id").over(order).isNull(), "[").otherwise(",")
    end = F.when(F.lead("doc_id").over(order).isNull(), "]").otherwise("")
    rows.select("list", F.concat(mark, record, end).alias("value")).write.partitionBy("list").text(path)
    return D.read_json_array(spark, path).select("title", "desc", "tag")


@query("snapshot", "S4 S5", with_(DOCS, TAGGED, select='SELECT doc_id, title, body AS "desc", tag FROM tagged'))
def snapshot(spark, sf):
    path = scratch_path(spark, "snapshot")
    D.write_snapshot(tagged_docs(spark, sf), path)
    return D.read_snapshot(spark, path)


@query(
    "word_list",
    "S7 M10",
    "SELECT DISTINCT unnest(str_split(p_name, ' ')) AS token FROM part",
)
def word_list(spark, sf):
    path = scratch_path(spark, "words")
    table(spark, sf, "part").select(F.explode(F.split("p_name", " "))).write.text(path)
    return read_word_table(spark, path)


@query(
    "word_files",
    "S7",
    "WITH words AS (SELECT DISTINCT unnest(str_split(replace(text, chr(10), ' '), ' ')) AS word FROM benchmark)"
    " SELECT doc_id, (SELECT count(*) FROM (SELECT unnest(str_split(text, ' ')) AS w) WHERE w IN (SELECT word FROM words))"
    " AS listed FROM documents",
)
def word_files(spark, sf):
    """Words of several files, counted in the documents."""
    path = scratch_path(spark, "words")
    words = F.explode(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")).alias("word")
    table(spark, sf, "benchmark").repartition(4, "item_id").select(words).write.text(path)
    known = read_word_table(spark, path)
    texts = table(spark, sf, "documents").select("doc_id", "text")
    # Words are counted inside of their document, and meet the list as rows.
    each = texts.select("doc_id", F.inline(term_counts(F.split("text", " ")))).withColumnRenamed("term", "token")
    listed = join_small_or_salted(each, known, ["token"], "inner", "doc_id").groupBy("doc_id").agg(F.sum("tf").alias("listed"))
    return texts.select("doc_id").join(listed, "doc_id", "left").withColumn("listed", F.coalesce("listed", F.lit(0).cast("long")))


@query(
    "charset_file",
    "S8 T15",
    "WITH c AS (SELECT DISTINCT unnest(str_split(p_name, '')) AS c FROM part)"
    " SELECT doc_id, (SELECT coalesce(string_agg(x, '' ORDER BY i), '') FROM (SELECT unnest(str_split(text, '')) AS x,"
    " generate_subscripts(str_split(text, ''), 1) AS i) WHERE x IN (SELECT c FROM c)) AS text FROM documents",
)
def charset_file(spark, sf):
    """Texts in the characters of the part names, read from files that spell every
    second one in hex digits."""
    path = scratch_path(spark, "charset")
    letters = table(spark, sf, "part").select(F.explode(F.split("p_name", "")).alias("c")).distinct()
    code = F.lpad(F.hex(F.ascii("c").cast("long")), 4, "0")
    spelt = F.when(F.ascii("c") % 2 == 0, code).otherwise(F.col("c"))
    letters.repartition(3, "c").select(spelt.alias("line")).write.text(path)
    legal = read_charset(spark, path)
    return table(spark, sf, "documents").select("doc_id", drop_illegal(F.col("text"), legal).alias("text"))


@query(
    "outcome_folders",
    "S11 S6",
    with_(
        DOCS,
        HITS,
        VERDICT,
        select='SELECT doc_id, outcome, title, body AS "desc", predict_tag, match FROM verdict'
        " QUALIFY row_number() OVER (PARTITION BY outcome ORDER BY doc_id) <= 10",
    ),
)
def outcome_folders(spark, sf):
    from doctag.operators.rules import outcome_report
    from doctag.plans.catalog.rules import tagged

    path = scratch_path(spark, "report")
    D.write_report(outcome_report(tagged(spark, sf), "doc_id", 10), path)
    schema = "doc_id long, title string, desc string, predict_tag string, match string, outcome string"
    return spark.read.schema(schema).json(path)


@query(
    "stream_tags",
    "R3 R4 R5 R6",
    with_(DOCS, HITS, VERDICT, select="SELECT doc_id, match, predict_tag FROM verdict"),
)
def stream_tags(spark, sf):
    """The rule tags of a stream of files, read back from its sink."""
    from doctag.plans.catalog.rules import BOOK
    from doctag.streaming.documents import read_document_stream, tag_stream

    base = scratch_path(spark, "stream")
    D.write_snapshot(docs(spark, sf), f"{base}/in")
    stream = read_document_stream(
        spark, f"{base}/in", D.read_snapshot(spark, f"{base}/in").schema, "parquet"
    )
    tag_stream(stream, BOOK, f"{base}/out", f"{base}/state").awaitTermination()
    return D.read_snapshot(spark, f"{base}/out").select("doc_id", "match", "predict_tag")
