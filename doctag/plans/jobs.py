"""The end-to-end jobs: from files to files, with every setting a parameter."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doctag.functions.tokens import TokenOptions, token_text, tokenize
from doctag.operators.bayes import fit_bayes, load_bayes, predict_bayes, save_bayes
from doctag.operators.dataset import (
    apply_decisions,
    by_label,
    preprocess,
    slice_rows,
    title_contains,
)
from doctag.operators.rules import OUTCOMES, outcome_counts, outcome_report, tag_documents
from doctag.operators.sampling import sample_exact, sample_fraction, training_set
from doctag.operators.token_tables import TokenTables, preprocess_by_tables
from doctag.operators.tfidf import fit_tfidf, load_tfidf, save_tfidf, transform_tfidf
from doctag.operators.vocabulary import vocabulary
from doctag.plans import training as P
from doctag.session import durable
from doctag.sources import documents as D
from doctag.sources.lists import read_rule_book


def with_key(df: DataFrame, key: str = "doc") -> DataFrame:
    """Documents without a key of their own, numbered in reading order. They are
    stored at once, because the numbers of a second read could differ."""
    return durable(df.withColumn(key, F.monotonically_increasing_id()))


def load(spark: SparkSession, documents: DataFrame | str, form: str) -> DataFrame:
    """Documents from a DataFrame, or from files of the form ``list``, ``lines`` or
    ``snapshot``. A list is read by one task per file, so its rows are dealt out."""
    if isinstance(documents, DataFrame):
        return documents
    readers = {"list": D.read_json_array, "lines": D.read_json_lines, "snapshot": D.read_snapshot}
    if form not in readers:
        raise ValueError(f"unknown form {form!r}, one of {sorted(readers)}")
    docs = readers[form](spark, documents)
    return docs.repartition(spark.sparkContext.defaultParallelism) if form == "list" else docs


def vocabulary_job(
    spark: SparkSession,
    documents: DataFrame | str,
    column: str,
    out: str,
    ngram: int = 5,
    options: TokenOptions = TokenOptions(),
    form: str = "lines",
) -> None:
    """Document frequency and rank of the tokens of one column."""
    docs = load(spark, documents, form)
    D.write_snapshot(vocabulary(docs, column, options, ngram), out)


def vectorizer_job(
    spark: SparkSession,
    documents: DataFrame | str,
    out: str,
    title_ngram: int = 10,
    desc_ngram: int = 5,
    max_df: float | int = 0.95,
    min_df: float | int = 0.005,
    options: TokenOptions = TokenOptions(),
    form: str = "list",
) -> PipelineModel:
    """Title and description vectorizers of the documents."""
    docs = load(spark, documents, form)
    seg = docs.select(
        token_text(tokenize(F.col("title"), replace(options, ngram=title_ngram))).alias("title_seg"),
        token_text(tokenize(F.col("desc"), replace(options, ngram=desc_ngram))).alias("desc_seg"),
    )
    model = P.vectorizer(fit_tfidf(seg, P.FIELDS, max_df, min_df))
    P.save_model(model, out)
    return model


def rule_job(
    spark: SparkSession,
    documents: DataFrame | str,
    rules: str,
    len_limit: int,
    out: str,
    titles: Sequence[str] = (),
    form: str = "list",
) -> dict[str, int]:
    """Tag the documents by a rule file; write one report folder per outcome and return
    the number of documents of each."""
    docs = title_contains(load(spark, documents, form), titles)
    tagged = durable(tag_documents(with_key(docs), read_rule_book(spark, rules)))
    D.write_report(outcome_report(tagged, "doc", len_limit), out)
    counts = {r.outcome: r.documents for r in outcome_counts(tagged).collect()}
    return {o: counts[o] for o in OUTCOMES}


def review_job(
    spark: SparkSession,
    predictions: str,
    decisions: DataFrame,
    out: str,
    key: str,
    default: str,
    pos: str,
    neg: str,
    label: str | None = None,
    begin: int | None = None,
    end: int | None = None,
    size: int | float = 1.0,
    seed: int = 0,
) -> DataFrame:
    """Rows ``[begin, end)`` with one predicted label, sampled, and tagged by the
    review codes. Returns the decisions that were rejected."""
    rows = by_label(slice_rows(D.read_snapshot(spark, predictions), key, begin, end), label)
    take = sample_exact if isinstance(size, int) else sample_fraction
    tagged, rejected = apply_decisions(take(rows, key, size, seed), decisions, key, default, pos, neg)
    D.write_snapshot(tagged, out)
    return rejected


def token_records(docs: DataFrame) -> dict[str, str | None]:
    """The options that the token texts were made with, as their columns record them."""
    return {c: docs.schema[c].metadata.get("tokens") for c in P.FIELDS.values()}


def publish(spark: SparkSession, out: str, docs: DataFrame, **about) -> None:
    """The manifest of a model: what it was fitted for. It is written last, so a model
    without one is not complete."""
    text = json.dumps({"tokens": token_records(docs), **about})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{out}/manifest")


def check_manifest(spark: SparkSession, models: str, docs: DataFrame) -> dict:
    """The manifest of a model; an error if it is missing, or if ``docs`` have token texts that
    were made with other options, or do not tell."""
    try:
        about = json.loads(spark.read.text(f"{models}/manifest").first()["value"])
    except AnalysisException:
        raise ValueError(f"{models} holds no complete model: its manifest is missing") from None
    own = token_records(docs)
    other = [c for c, record in about["tokens"].items() if own.get(c) != record]
    if other:
        raise ValueError(f"{', '.join(other)}: token texts made with other options than those of {models}")
    return about


def training_job(
    spark: SparkSession,
    documents: DataFrame,
    key: str,
    label: str,
    out: str,
    kind: str = "bayes",
    vectors: PipelineModel | None = None,
    seed: int = 0,
    salt: str = "",
    **params,
) -> tuple[PipelineModel, PipelineModel]:
    """Pre-process labelled documents, balance them for ``label``, fit the vectorizers
    unless given, fit a classifier and save both."""
    docs = durable(preprocess(documents, salt=salt, key=key))
    vectors = vectors or P.fit_vectorizer(docs)
    train = durable(P.vectorize(training_set(docs, label, key, seed), vectors))
    model = P.fit(train, kind, **params)
    P.save_model(vectors, f"{out}/vectors")
    P.save_model(model, f"{out}/classifier")
    publish(spark, out, docs, label=label, kind=kind)
    return vectors, model


def prediction_job(
    spark: SparkSession, documents: str, models: str, out: str, only: str | None = None
) -> None:
    """Predict a document set snapshot with saved models; ``only`` keeps one label.
    Token columns are dropped from the JSON records written."""
    docs = D.read_snapshot(spark, documents)
    check_manifest(spark, models, docs)
    data = P.vectorize(docs, P.load_model(f"{models}/vectors"))
    done = P.predict(P.load_model(f"{models}/classifier"), data)
    D.write_json_records(by_label(done, only).drop("features", "title_seg", "desc_seg"), out)


def long_training_job(
    spark: SparkSession,
    documents: DataFrame,
    key: str,
    label: str,
    out: str,
    max_df: float | int | Mapping[str, float | int] = 0.95,
    min_df: float | int | Mapping[str, float | int] = 0.005,
    seed: int = 0,
    options: TokenOptions = TokenOptions(ngram=5),
    tables: TokenTables | None = None,
) -> None:
    """Like ``training_job`` for vocabularies of any length: TF-IDF of all documents and
    a naive Bayes model of the balanced ones, as tables below ``out``. ``tables`` are word
    lists that are too long for the options."""
    by_tables = tables is not None
    docs = preprocess_by_tables(documents, key, tables, options) if by_tables else preprocess(documents, options, key=key)
    docs = durable(docs)
    model = fit_tfidf(docs, P.FIELDS, max_df, min_df)
    save_tfidf(model, f"{out}/tfidf")
    train = training_set(docs.filter(F.col("tag").isNotNull()), label, key, seed)
    weights = transform_tfidf(train, model, key, P.FIELDS)
    classes = sorted(r.tag for r in train.select("tag").distinct().collect())
    save_bayes(fit_bayes(weights, train.select(key, "tag"), model.terms, key, classes), f"{out}/bayes")
    publish(spark, out, docs, label=label, classes=classes)


def long_prediction_job(
    spark: SparkSession, documents: str, models: str, out: str, key: str, only: str | None = None
) -> None:
    """Predict a document set snapshot with the tables of ``long_training_job``."""
    docs = D.read_snapshot(spark, documents)
    check_manifest(spark, models, docs)
    weights = transform_tfidf(docs, load_tfidf(spark, f"{models}/tfidf"), key, P.FIELDS)
    done = predict_bayes(weights, docs.drop("title_seg", "desc_seg"), load_bayes(spark, f"{models}/bayes"), key)
    D.write_json_records(by_label(done, only).drop("probability"), out)
