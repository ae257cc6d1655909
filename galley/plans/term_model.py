"""Naive Bayes over exact terms, with its state and its weights as tables.

A class's sums of term counts, the terms' document frequencies and the numbers of articles are all the
model depends on. They are kept as increments whose sums are the state, so training again adds the new
articles only. Weights are a table by term and scoring is a join; nothing as long as the vocabulary
reaches the driver.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from galley.operators.features import inverse_frequency, row_term_counts
from galley.operators.skew import joined_by_term
from galley.operators.terms import numbered_rows, term_pairs
from galley.session import materialize, scratch_path
from galley.sources.batches import append_batch, read_batches

ARTICLES, CLASSES, TERMS = "digest binary", "topic string, n bigint", "topic string, term string, tf bigint, df bigint"


def tokens(text: str = "lemm_summary") -> Column:
    return F.split(F.lower(text), "\\s")


def add_articles(rows: DataFrame, path: str, batch: str | None = None) -> None:
    """Add normalized articles ``(lemm_summary, topic)`` to the state at ``path``.

    An article that the state holds, or that comes twice, counts once, as in one fit over all of them;
    rows with a null count nothing. A batch of one name takes effect once, so a lost job can be repeated.
    Batches are added one after the other.
    """
    known = read_batches(rows.sparkSession, path, "articles", ARTICLES).select("digest")
    content = F.concat(F.octet_length("topic").cast("string"), F.lit(":"), "topic", "lemm_summary")
    own = rows.where("topic IS NOT NULL AND lemm_summary IS NOT NULL").select("topic", "lemm_summary", F.unhex(F.sha2(content, 256)).alias("digest"))
    new = materialize(own.dropDuplicates(["topic", "lemm_summary"]).join(known, "digest", "left_anti"), "new_articles")
    counted = new.select("topic", F.inline(row_term_counts(tokens())))
    sums = counted.groupBy("topic", "term").agg(F.sum("tf").alias("tf"), F.count("*").alias("df"))
    sizes = new.groupBy("topic").agg(F.count("*").alias("n"))
    append_batch({"terms": sums, "classes": sizes, "articles": new.select("digest")}, path, batch or uuid.uuid4().hex)


def merge_batches(spark: SparkSession, path: str, target: str) -> None:
    """Write the state at ``path`` as a single batch to ``target``, which keeps reads short after many batches."""
    classes = read_batches(spark, path, "classes", CLASSES).groupBy("topic").agg(F.sum("n").alias("n"))
    terms = read_batches(spark, path, "terms", TERMS).groupBy("topic", "term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
    articles = read_batches(spark, path, "articles", ARTICLES).select("digest")
    append_batch({"terms": terms, "classes": classes, "articles": articles}, target, "merged")


@dataclass(frozen=True)
class TermModel:
    """Weights by term ``(term, idf, weights)``, and per class its name, prior and weight of an absent term.

    ``weights`` holds ``ln(sum + smoothing)`` for each class. The classes are those of the training
    articles, as many as a report has rows.
    """

    terms: DataFrame
    labels: tuple[str, ...]
    priors: tuple[float, ...]
    bases: tuple[float, ...]
    smoothing: float = 1.0

    def save(self, path: str) -> None:
        """Replace the model at ``path``. The terms get a folder of their own, named by the classes written last."""
        spark = self.terms.sparkSession
        folder = f"terms-{uuid.uuid4().hex}"
        self.terms.write.parquet(f"{path}/{folder}")
        rows = [(i, *row, self.smoothing, folder) for i, row in enumerate(zip(self.labels, self.priors, self.bases))]
        table = spark.createDataFrame(rows, "position int, topic string, prior double, base double, smoothing double, folder string")
        table.coalesce(1).write.mode("overwrite").parquet(f"{path}/classes")


def load(spark: SparkSession, path: str) -> TermModel | None:
    """The model saved at ``path``, or None if what is there is none of this kind."""
    try:
        rows = spark.read.parquet(f"{path}/classes").orderBy("position").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    terms = spark.read.parquet(f"{path}/{rows[0].folder}")
    return TermModel(terms, *(tuple(row[c] for row in rows) for c in ("topic", "prior", "base")), rows[0].smoothing)


def fit(spark: SparkSession, path: str, min_doc_freq: int = 3, smoothing: float = 1.0) -> TermModel:
    """The model of the articles added to the state at ``path``; without any it is an error.

    Multinomial naive Bayes on TF-IDF: a class's sum for a term is its count times the term's inverse
    frequency, which only the whole state gives, so the state holds counts. Classes are numbered by
    frequency, ties alphabetically.
    """
    classes = read_batches(spark, path, "classes", CLASSES).groupBy("topic").agg(F.sum("n").alias("n"))
    classes = classes.orderBy(F.desc("n"), "topic").collect()
    if not classes:
        raise ValueError(f"no articles at {path}")
    labels, total = tuple(row.topic for row in classes), sum(row.n for row in classes)
    own = [F.coalesce(F.sum(F.when(F.col("topic") == name, F.col("tf"))), F.lit(0)) for name in labels]
    counts = read_batches(spark, path, "terms", TERMS).groupBy("term").agg(F.sum("df").alias("df"), F.array(*own).alias("tf"))
    idf = inverse_frequency(F.lit(total), F.col("df"), min_doc_freq)
    weighted = counts.select("term", idf.alias("idf"), F.transform("tf", lambda n: n * idf).alias("sums"))
    weighted = materialize(weighted, "class_sums")
    sums = [F.coalesce(F.sum(F.get("sums", F.lit(i))), F.lit(0.0)) for i in range(len(labels))]
    over = weighted.agg(F.count("*").alias("terms"), F.array(*sums).alias("sums")).first()
    terms = weighted.where("idf > 0").select("term", "idf", F.transform("sums", lambda s: F.ln(s + smoothing)).alias("weights"))
    priors = tuple(math.log((row.n + smoothing) / (total + smoothing * len(labels))) for row in classes)
    return TermModel(terms, labels, priors, tuple(math.log(s + smoothing * over.terms) for s in over.sums), smoothing)


def fit_once(rows: DataFrame, **options) -> TermModel:
    """The model of ``rows`` alone."""
    path = scratch_path(rows.sparkSession, "term_state")
    add_articles(rows, path)
    return fit(rows.sparkSession, path, **options)


def score(df: DataFrame, model: TermModel) -> DataFrame:
    """All rows of ``df`` with ``category`` and ``confidence``, its probability.

    The distinct terms of each row meet their weights in one join; a row's sums are one number per class.
    Unknown terms count nothing, and a row without known ones (a null or empty text) gets the largest
    class. Of equal scores the class of the smaller position wins.
    """
    rows = numbered_rows(df, "to_score")
    x, places = F.col("tf") * F.col("idf"), range(len(model.labels))
    pairs = joined_by_term(term_pairs(rows, "_row", tokens()), model.terms)
    sums = pairs.groupBy("_row").agg(F.sum(x).alias("_all"), F.array(*[F.sum(x * F.get("weights", F.lit(i))) for i in places]).alias("_own"))
    scores = [
        F.coalesce(F.get("_own", F.lit(i)) - F.col("_all") * model.bases[i], F.lit(0.0)) + model.priors[i] for i in places
    ]
    scored = rows.join(sums, "_row", "left").select(*df.columns, F.array(*scores).alias("_scores"))
    top = F.array_max("_scores")
    place = F.array_position("_scores", top).cast("int") - 1
    spread = F.aggregate(F.transform("_scores", lambda s: F.exp(s - top)), F.lit(0.0), lambda a, b: a + b)
    return scored.select(*df.columns, F.get(F.array(*map(F.lit, model.labels)), place).alias("category"), (1 / spread).alias("confidence"))
