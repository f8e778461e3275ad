"""Vectors, classifiers, bulk prediction and evaluation on Spark ML.

The classifiers need one vector index per term, so the vocabulary of this form
has to fit in memory of every task. Its size is checked when fitting; the long
form in doctag.operators.tfidf and doctag.operators.bayes has no such bound.
"""

from __future__ import annotations

from collections.abc import Mapping

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, NaiveBayes
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import (
    CountVectorizer,
    CountVectorizerModel,
    ElementwiseProduct,
    IndexToString,
    Normalizer,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from doctag.operators.metrics import macro_f1, report
from doctag.operators.sampling import split_exact, stratified_folds
from doctag.operators.tfidf import FittedTfidf, fit_tfidf

FIELDS = {"title": "title_seg", "desc": "desc_seg"}
MAX_VECTOR_TERMS = 2_000_000


def vectorizer(
    fitted: FittedTfidf, fields: Mapping[str, str] = FIELDS, arrays: bool = False
) -> PipelineModel:
    """Stages from token texts, or from ``arrays`` of tokens, to one vector: the first
    field's block, then the next. Each block is tf times idf at unit length."""
    if fitted.terms.count() > MAX_VECTOR_TERMS:
        raise ValueError(
            f"more than {MAX_VECTOR_TERMS} terms do not fit a vector model; "
            "raise min_df or use the long form"
        )
    # An array without tokens has one empty term, as its token text does.
    terms = "IF(size({0}) = 0, array(''), {0})" if arrays else "split(lower({0}), '[|]')"
    split = ", ".join(f"{terms.format(c)} AS {n}_terms" for n, c in fields.items())
    stages = [SQLTransformer(statement=f"SELECT *, {split} FROM __THIS__")]
    for name in fields:
        own = fitted.terms.filter(F.col("field") == name)
        # Fitted on the vocabulary itself, one term per row, so nothing is lost.
        counts = CountVectorizer(
            vocabSize=MAX_VECTOR_TERMS, inputCol=f"{name}_terms", outputCol=f"{name}_tf"
        ).fit(own.select(F.array("term").alias(f"{name}_terms")))
        idf = {r.term: r.idf for r in own.select("term", "idf").collect()}
        scale = ElementwiseProduct(
            scalingVec=Vectors.dense([idf[t] for t in counts.vocabulary]),
            inputCol=f"{name}_tf",
            outputCol=f"{name}_tfidf",
        )
        unit = Normalizer(p=2.0, inputCol=f"{name}_tfidf", outputCol=f"{name}_vec")
        stages += [counts, scale, unit]
    stages.append(VectorAssembler(inputCols=[f"{n}_vec" for n in fields], outputCol="features"))
    return PipelineModel(stages)


def fit_vectorizer(
    df: DataFrame, max_df: float | int = 0.95, min_df: float | int = 0.005
) -> PipelineModel:
    """Title and description vectorizers, fitted in one pass."""
    return vectorizer(fit_tfidf(df, FIELDS, max_df, min_df))


def vectorize(df: DataFrame, vectors: PipelineModel) -> DataFrame:
    """``df`` with the stacked ``features`` and nothing else added."""
    return vectors.transform(df).select(*df.columns, "features")


def _estimator(kind: str, params: dict):
    kinds = {
        "bayes": lambda: NaiveBayes(modelType="multinomial", smoothing=1.0),
        "tree": lambda: DecisionTreeClassifier(maxDepth=30),
        "svc": lambda: LinearSVC(),
        "linear": lambda: LinearRegression(),
    }
    if kind not in kinds:
        raise ValueError(f"unknown classifier {kind!r}, one of {sorted(kinds)}")
    return kinds[kind]().setParams(labelCol="label", featuresCol="features", **params)


def fit(df: DataFrame, kind: str, label: str = "tag", **params) -> PipelineModel:
    """A classifier over ``features``: ``bayes``, ``tree``, ``svc`` or ``linear``.
    The fitted pipeline adds ``predict`` in terms of the label column."""
    index = StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc").fit(df)
    estimator = _estimator(kind, params)
    model = estimator.fit(index.transform(df).select("features", "label"))
    stages = [model]
    if kind == "linear":
        stages.append(
            SQLTransformer(
                statement="SELECT *, CASE WHEN prediction > 0.5 THEN 1.0D ELSE 0.0D END AS cut FROM __THIS__"
            )
        )
    stages.append(
        IndexToString(
            inputCol="cut" if kind == "linear" else "prediction",
            outputCol="predict",
            labels=list(index.labels),
        )
    )
    return PipelineModel(stages)


def fit_thresholds(df: DataFrame, thresholds: Mapping[str, float], label: str = "tag") -> PipelineModel:
    """Naive Bayes that prefers the class with the largest probability divided by
    its threshold."""
    values = [thresholds[c] for c in sorted(thresholds)]
    return fit(df, "bayes", label, thresholds=values)


def predict(model: PipelineModel, df: DataFrame, out: str = "predict", scores: bool = False) -> DataFrame:
    """``df`` with the predicted label; ``scores`` keeps the class probabilities
    as an array."""
    done = model.transform(df)
    cols = [F.col(c) for c in df.columns if c != out] + [F.col("predict").alias(out)]
    if scores:
        cols.append(vector_to_array("probability").alias("probability"))
    return done.select(*cols)


def predict_all(models: Mapping[str, PipelineModel], df: DataFrame) -> DataFrame:
    """Several predictions side by side, one column per entry."""
    for name, model in models.items():
        df = predict(model, df, name)
    return df


def cutoff(df: DataFrame, score: str | Column, c: float, out: str = "predict") -> DataFrame:
    """``'1'`` where the score is above ``c``, else ``'0'``."""
    score = F.col(score) if isinstance(score, str) else score
    return df.withColumn(out, F.when(score > c, "1").otherwise("0"))


class MacroF1Evaluator(Evaluator, HasLabelCol, HasPredictionCol):
    """The plain mean of the F1 of all labels."""

    def __init__(self, labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._set(labelCol=labelCol, predictionCol=predictionCol)

    def _evaluate(self, dataset):
        return macro_f1(dataset, self.getLabelCol(), self.getPredictionCol()).first()["macro_f1"]

    def isLargerBetter(self):
        return True


def _indexed(df: DataFrame, label: str) -> DataFrame:
    index = StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc")
    return index.fit(df).transform(df)


def cross_val_f1(
    df: DataFrame, kind: str, key: str, k: int = 6, label: str = "tag", seed: int = 0, **params
) -> DataFrame:
    """``fold, macro_f1`` over stratified folds of labelled vectors."""
    folds = stratified_folds(_indexed(df, label), key, label, k, seed).select(
        "features", "label", F.col("fold").cast("int").alias("fold")
    ).persist()
    try:
        scores = [
            (
                fold,
                _fit_score(
                    folds.filter(F.col("fold") != fold),
                    folds.filter(F.col("fold") == fold),
                    kind,
                    params,
                ),
            )
            for fold in range(k)
        ]
    finally:
        folds.unpersist()
    return df.sparkSession.createDataFrame(scores, "fold int, macro_f1 double")


def cross_validate(
    df: DataFrame, kind: str, key: str, grid: Mapping[str, list], k: int = 3, label: str = "tag", seed: int = 0
) -> tuple[object, DataFrame]:
    """The best model of a parameter grid and its mean scores, on the same folds."""
    folds = stratified_folds(_indexed(df, label), key, label, k, seed).withColumn(
        "fold", F.col("fold").cast("int")
    )
    estimator = _estimator(kind, {})
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), values)
    maps = builder.build()
    fitted = CrossValidator(
        estimator=Pipeline(stages=[estimator]),
        estimatorParamMaps=maps,
        evaluator=MacroF1Evaluator(),
        numFolds=k,
        foldCol="fold",
    ).fit(folds.select("features", "label", "fold"))
    rows = [
        (", ".join(f"{p.name}={v}" for p, v in m.items()), float(score))
        for m, score in zip(maps, fitted.avgMetrics)
    ]
    return fitted.bestModel, df.sparkSession.createDataFrame(rows, "params string, macro_f1 double")


def _predicted(model, df: DataFrame, kind: str) -> DataFrame:
    out = model.transform(df)
    if kind != "linear":
        return out
    return out.withColumn("prediction", F.when(F.col("prediction") > 0.5, 1.0).otherwise(0.0))


def _fit_score(train: DataFrame, valid: DataFrame, kind: str, params: dict) -> float:
    model = _estimator(kind, params).fit(train)
    return MacroF1Evaluator()._evaluate(_predicted(model, valid, kind))


def learning_curve(
    df: DataFrame,
    kind: str,
    key: str,
    sizes=(0.2, 0.4, 0.6, 0.8, 1.0),
    splits: int = 100,
    test: float = 0.2,
    label: str = "tag",
    seed: int = 0,
    **params,
) -> DataFrame:
    """``train_fraction, split, train_score, valid_score``: macro F1 on the used
    part of the training side and on the test side of each shuffle split."""
    from doctag.operators.sampling import sample_fraction

    base = _indexed(df, label).select(key, "features", "label").persist()
    rows = []
    try:
        for split in range(splits):
            train, valid = split_exact(base, key, test, seed + split)
            for size in sizes:
                part = train if size >= 1.0 else sample_fraction(train, key, size, f"{seed + split}/size")
                model = _estimator(kind, params).fit(part)
                score = MacroF1Evaluator()._evaluate
                rows.append(
                    (
                        float(size),
                        split,
                        score(_predicted(model, part, kind)),
                        score(_predicted(model, valid, kind)),
                    )
                )
    finally:
        base.unpersist()
    return df.sparkSession.createDataFrame(
        rows, "train_fraction double, split int, train_score double, valid_score double"
    )


def evaluate_split(
    df: DataFrame, kind: str, key: str, test: float = 0.3, seed: int = 0, label: str = "tag", **params
) -> DataFrame:
    """Reports of a model on its own training rows (``in_sample``) and of a model
    that never saw the test rows (``hold_out``)."""
    train, held = split_exact(df, key, test, seed)
    parts = [("in_sample", df, df), ("hold_out", train, held)]
    reports = [
        report(predict(fit(a, kind, label, **params), b), label).withColumn("sample", F.lit(name))
        for name, a, b in parts
    ]
    return reports[0].unionByName(reports[1])


def term_index(spark: SparkSession, vectors: PipelineModel, fields: Mapping[str, str] = FIELDS) -> DataFrame:
    """``field, term, index``: the place of each term in the stacked vector. A
    field's indexes start behind the vocabulary of the field before it."""
    blocks = [s.vocabulary for s in vectors.stages if isinstance(s, CountVectorizerModel)]
    terms = [(field, term) for field, block in zip(fields, blocks) for term in block]
    return spark.createDataFrame(
        pd.DataFrame(terms, columns=["field", "term"]).assign(index=range(len(terms))),
        "field string, term string, index long",
    )


def term_log_probability(spark: SparkSession, model: PipelineModel, vectors: PipelineModel) -> DataFrame:
    """``class, field, term, logp`` of a fitted naive Bayes model."""
    theta = model.stages[0].theta.toArray()
    labels = model.stages[-1].getLabels()
    table = spark.createDataFrame(
        pd.DataFrame({"index": range(theta.shape[1]), "logps": theta.T.tolist()}),
        "index long, logps array<double>",
    )
    names = F.array(*[F.lit(c) for c in labels])
    return (
        term_index(spark, vectors)
        .join(table, "index")
        .select("field", "term", F.posexplode("logps").alias("_i", "logp"))
        .select(F.get(names, "_i").alias("class"), "field", "term", "logp")
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
