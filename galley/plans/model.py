"""Train, evaluate, save, load and retrain the topic classifier."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF, HashingTF, IndexToString, StringIndexer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galley.operators import features, metrics
from galley.plans import term_model
from galley.plans.forest import SparseForestClassifier
from galley.plans.normalize import normalize
from galley.plans.term_model import TermModel
from galley.session import materialize


Model = PipelineModel | TermModel


def classifier(name: str = "naive_bayes", **params) -> Estimator:
    """``naive_bayes`` (multinomial, smoothing 1) or ``random_forest`` (500 trees)."""
    if name == "naive_bayes":
        return NaiveBayes(**params)
    if name == "random_forest":
        return SparseForestClassifier(**{"numTrees": 500, **params})
    raise ValueError(f"unknown classifier {name!r}")


def feature_stages(vectorizer: str = "hashing", num_features: int = 1 << 18, min_doc_freq: int = 3) -> list:
    """Tokenizer, term counts and IDF; ``count`` uses all exact terms instead of hash buckets.

    As stages of a pipeline the exact terms are part of the model, which the driver holds; naive Bayes over
    exact terms is a ``TermModel`` instead.
    """
    if vectorizer == "hashing":
        counts = HashingTF(inputCol="words", outputCol="rawFeatures", numFeatures=num_features)
    elif vectorizer == "count":
        counts = _AllTerms(inputCol="words", outputCol="rawFeatures")
    else:
        raise ValueError(f"unknown vectorizer {vectorizer!r}")
    return [
        Tokenizer(inputCol="lemm_summary", outputCol="words"),
        counts,
        IDF(minDocFreq=min_doc_freq, inputCol="rawFeatures", outputCol="features"),
    ]


class _AllTerms(Estimator, HasInputCol, HasOutputCol):
    """Count vectors over every term of the data."""

    def __init__(self, inputCol: str, outputCol: str):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _fit(self, dataset: DataFrame):
        return features.count_vectorizer(dataset, self.getInputCol(), self.getOutputCol())


# Reducers per class that merge the dense sums of all tasks.
SUM_PARTS = 16


def class_sums(featured: DataFrame, parts: int = SUM_PARTS) -> DataFrame:
    """Mean feature vectors and row counts per class, in ``parts`` parts.

    Multinomial naive Bayes depends on the weighted sums per class alone, so fitting on these rows
    with their counts as weights gives the same model. Fitting on single rows sends the dense sums
    of all tasks to as many reducers as there are classes; here they go to ``parts`` times as many.
    """
    part = (F.spark_partition_id() % parts).alias("part")
    summary = Summarizer.metrics("mean", "count").summary(F.col("features")).alias("summary")
    sums = featured.groupBy("label", part).agg(summary)
    return sums.select("label", F.col("summary.mean").alias("features"), F.col("summary.count").cast("double").alias("weight"))


def _fit_classifier(estimator: Estimator, featured: DataFrame):
    additive = isinstance(estimator, NaiveBayes) and estimator.getModelType() == "multinomial"
    if additive and not estimator.isSet("weightCol"):
        return estimator.copy().setWeightCol("weight").fit(class_sums(featured))
    return estimator.fit(featured)


def _fit(train: DataFrame, labelled: DataFrame, estimator: Estimator | None, **feature_options) -> PipelineModel:
    """Label index, features, classifier and the decoding of class indexes to names, as one model."""
    # The indexer sees the whole frame, so a topic that is rare in the training part has an index.
    # It is saved with the model and ignored by frames without a topic.
    indexer = StringIndexer(inputCol="topic", outputCol="label").fit(labelled)
    prepared = Pipeline(stages=[indexer, *feature_stages(**feature_options)]).fit(train)
    fitted = _fit_classifier(estimator or classifier(), prepared.transform(train))
    decoder = IndexToString(inputCol="prediction", outputCol="category", labels=indexer.labels)
    return PipelineModel(stages=[*prepared.stages, fitted, decoder])


@dataclass(frozen=True)
class Training:
    model: Model
    predictions: DataFrame
    report: DataFrame
    confusion: DataFrame
    scores: DataFrame


def train(
    normalized: DataFrame,
    path: str | None = None,
    percent: int = 80,
    estimator: Estimator | None = None,
    **feature_options,
) -> Training:
    """Fit on one part of ``(lemm_summary, topic)``, evaluate on the other, save if a path is given.

    The normalized rows are read by every fitting pass, so they are written once first. The split
    depends on their content alone. ``vectorizer="count"`` without an ``estimator`` fits naive Bayes over
    exact terms as tables.
    """
    rows = materialize(normalized.select("lemm_summary", "topic"), "normalized")
    training, test = features.split(rows, F.concat_ws("\x1f", "topic", "lemm_summary"), percent)
    if estimator is None and feature_options.get("vectorizer") == "count":
        model = _fit_terms(training, **feature_options)
        indexer = StringIndexer(inputCol="topic", outputCol="label").fit(rows)
        labels = indexer.labels
        guessed = indexer.transform(term_model.score(test, model))
        predicted = F.array_position(F.array(*map(F.lit, labels)), F.col("category")) - 1
        predictions = guessed.withColumn("prediction", predicted.cast("double"))
    else:
        model = _fit(training, rows, estimator, **feature_options)
        labels = model.stages[0].labels
        predictions = model.transform(test)
    if path is not None:
        save_model(model, path)
    predictions = materialize(predictions.select("lemm_summary", "topic", "label", "prediction", "category"), "predictions")
    return Training(
        model=model,
        predictions=predictions,
        report=metrics.classification_report(predictions, "topic", "category"),
        confusion=metrics.confusion_matrix(predictions, labels, "topic", "category"),
        scores=metrics.f1_and_test_error(predictions),
    )


def _fit_terms(rows: DataFrame, vectorizer: str = "count", **options) -> TermModel:
    return term_model.fit_once(rows, **options)


def save_model(model: Model, path: str) -> None:
    if isinstance(model, TermModel):
        model.save(path)
    else:
        model.write().overwrite().save(path)


def load_model(path: str) -> Model:
    """The model saved at ``path``, of either kind."""
    return term_model.load(SparkSession.active(), path) or PipelineModel.load(path)


def score(df: DataFrame, model: Model) -> DataFrame:
    """All rows with ``category`` and the probability of that class.

    A ``PipelineModel`` also works on streams; a ``TermModel`` joins and needs a batch.
    """
    if isinstance(model, TermModel):
        return term_model.score(df, model)
    scored = model.transform(df)
    probability = F.array_max(vector_to_array("probability"))
    return scored.select(*df.columns, "category", probability.alias("confidence"))


def retrain(
    history: DataFrame, base: DataFrame | None, path: str, normalize_options: dict | None = None, **feature_options
) -> Model:
    """Fit a fresh classifier on the predicted history, joined by the base articles if given.

    The result replaces the model at ``path``, the one that scoring loads. With ``vectorizer="count"`` the
    state of the classifier stays beside it and only grows: articles counted before, by this or an
    earlier call, are skipped, so the rows since the last training (``newer_than_last_training``) are
    enough, and the whole history gives the same model.
    """
    articles = history.withColumnsRenamed({"category": "topic"}).select("summary", "topic")
    if base is not None:
        articles = articles.unionByName(base.select("summary", "topic"))
    rows = materialize(normalize(articles, **(normalize_options or {})), "retrain")
    if feature_options.get("vectorizer") == "count":
        options = {k: v for k, v in feature_options.items() if k != "vectorizer"}
        term_model.add_articles(rows, f"{path}/state")
        model = term_model.fit(rows.sparkSession, f"{path}/state", **options)
    else:
        model = _fit(rows, rows, None, **feature_options)
    save_model(model, path)
    return model
