"""Cross-validation of naive Bayes over hash buckets, all folds and sizes from one pass of sums.

A multinomial naive Bayes model is a function of sums over its training articles. So the sums are made once
per fold, and the model without a fold follows by subtraction; nothing is tokenized or counted again for a
fold or for a number of buckets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galley.operators import metrics
from galley.operators.features import inverse_frequency, row_term_counts
from galley.operators.terms import numbered_rows
from galley.plans.term_model import tokens
from galley.session import materialize

#: Model entries (folds x buckets x classes) up to which they are broadcast: 8 bytes each, so 32 MB.
BROADCAST_ENTRIES = 4 << 20


@dataclass(frozen=True)
class CrossValidation:
    """``scores``: (num_features, fold, f1); ``best``: the number of buckets with the highest mean, the smaller of equals."""

    scores: DataFrame
    predictions: DataFrame
    best: int


def hash_number(value: Column, start: int = 1) -> Column:
    """32 bits of the MD5 of a text, from a hexadecimal digit on; the same in every engine."""
    return F.conv(F.substring(F.md5(value), start, 8), 16, 10).cast("bigint")


def cross_validate(
    normalized: DataFrame, num_features: Sequence[int] = (1000, 2000), folds: int = 3, min_doc_freq: int = 3, smoothing: float = 1.0
) -> CrossValidation:
    """Weighted F1 of each fold's articles under the model of the other folds, per number of buckets.

    Folds follow from the content of ``(topic, lemm_summary)``, so they do not depend on partitioning. Terms
    fall into buckets by their MD5; counts in one bucket add up. A class that a fold's model lacks is not
    predicted. Rows with nulls are left out.
    """
    content = F.concat_ws("\x1f", "topic", "lemm_summary")
    rows = normalized.where("topic IS NOT NULL AND lemm_summary IS NOT NULL")
    rows = numbered_rows(rows.select("topic", (hash_number(content, 9) % folds).alias("fold"), row_term_counts(tokens()).alias("terms")), "folded")
    sizes = {(row.fold, row.topic): row.n for row in rows.groupBy("fold", "topic").agg(F.count("*").alias("n")).collect()}
    labels = sorted({topic for _, topic in sizes}, key=lambda t: (-sum(sizes.get((f, t), 0) for f in range(folds)), t))
    grid = F.explode(F.array(*[F.lit(n).cast("bigint") for n in num_features])).alias("num_features")
    hashed = rows.select("_row", "topic", "fold", F.inline("terms")).select("_row", "topic", "fold", hash_number(F.col("term")).alias("hash"), "tf", grid)
    bucket = (F.col("hash") % F.col("num_features")).alias("bucket")
    counts = hashed.groupBy("_row", "topic", "fold", "num_features", bucket).agg(F.sum("tf").alias("tf"))
    counts = materialize(counts, "bucketed")
    model = _left_out_sums(counts, sizes, labels, folds, min_doc_freq)
    predictions = materialize(_predictions(counts, model, sizes, labels, folds, smoothing, folds * sum(num_features)), "predictions")
    scores = materialize(metrics.f1_by(predictions, ["num_features", "fold"]), "scores")
    means = scores.groupBy("num_features").agg(F.avg("f1").alias("f1")).orderBy(F.desc("f1"), "num_features")
    best = means.first()
    return CrossValidation(scores, predictions, best.num_features if best else min(num_features))


def _left_out_sums(counts: DataFrame, sizes: dict, labels: Sequence[str], folds: int, min_doc_freq: int) -> DataFrame:
    """``(num_features, bucket, fold, idf, sums)``: a fold's model is made of what the other folds sum up to."""
    bucket = ["num_features", "bucket"]
    per_class = F.array(*[F.coalesce(F.sum(F.when(F.col("topic") == name, F.col("tf"))), F.lit(0)) for name in labels])
    own = materialize(counts.groupBy(*bucket, "fold").agg(per_class.alias("own_tf"), F.count("*").alias("own_df")), "fold_sums")
    columns = [F.sum(F.get("own_tf", F.lit(i))) for i in range(len(labels))]
    total = own.groupBy(*bucket).agg(F.array(*columns).alias("tf"), F.sum("own_df").alias("df"))
    left_out = total.select("*", F.explode(F.array(*[F.lit(f).cast("bigint") for f in range(folds)])).alias("fold"))
    joined = left_out.join(own, [*bucket, "fold"], "left")
    rest = F.zip_with("tf", F.coalesce("own_tf", F.transform("tf", lambda _: F.lit(0).cast("bigint"))), lambda a, b: a - b)
    articles = F.get(F.array(*[F.lit(sum(n for (g, _), n in sizes.items() if g != f)) for f in range(folds)]), F.col("fold").cast("int"))
    idf = inverse_frequency(articles, F.col("df") - F.coalesce("own_df", F.lit(0)), min_doc_freq)
    found = joined.select(*bucket, "fold", idf.alias("idf"), rest.alias("rest"))
    return materialize(found.select(*bucket, "fold", "idf", F.transform("rest", lambda n: n * F.col("idf")).alias("sums")), "left_out")


def _predictions(counts: DataFrame, model: DataFrame, sizes: dict, labels: Sequence[str], folds: int, smoothing: float, entries: int) -> DataFrame:
    """``(_row, num_features, fold, label, prediction)``: each article under the model without its fold."""
    spark, places = counts.sparkSession, range(len(labels))
    totals = model.groupBy("num_features", "fold").agg(F.array(*[F.sum(F.get("sums", F.lit(i))) for i in places]).alias("sums")).collect()
    constants = []
    for row in totals:
        trained = [sum(sizes.get((f, name), 0) for f in range(folds) if f != row.fold) for name in labels]
        priors = [math.log(n + smoothing) if n else -math.inf for n in trained]
        constants.append((row.num_features, row.fold, priors, [math.log(s + smoothing * row.num_features) for s in row.sums]))
    models = spark.createDataFrame(constants, "num_features bigint, fold bigint, priors array<double>, bases array<double>")
    weights = model.select("num_features", "bucket", "fold", "idf", F.transform("sums", lambda s: F.ln(s + smoothing)).alias("weights"))
    if entries * len(labels) <= BROADCAST_ENTRIES:
        weights = F.broadcast(weights)
    x = F.col("tf") * F.col("idf")
    own = F.array(*[F.sum(x * F.get("weights", F.lit(i))) for i in places])
    keys = ["_row", "topic", "fold", "num_features"]
    sums = counts.join(weights, ["num_features", "bucket", "fold"]).groupBy(*keys).agg(F.sum(x).alias("all"), own.alias("own"))
    joined = sums.join(F.broadcast(models), ["num_features", "fold"])  # one row per fold and size
    scores = F.transform("own", lambda s, i: s - F.col("all") * F.get("bases", i) + F.get("priors", i))
    scored = joined.select("_row", "num_features", "fold", F.col("topic").alias("label"), scores.alias("scores"))
    place = F.array_position("scores", F.array_max("scores")).cast("int") - 1
    return scored.select("_row", "num_features", "fold", "label", F.get(F.array(*map(F.lit, labels)), place).alias("prediction"))
