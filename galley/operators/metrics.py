"""Classifier metrics from grouped counts; labels and predictions are never collected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pair_counts(df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """Rows per (label, prediction): at most the square of the number of classes, for each group of ``by``."""
    return df.groupBy(*by, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count("*").alias("n"))


def confusion_matrix(
    df: DataFrame, classes: Sequence | None = None, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row per label, one column per predicted class; give the classes to save a job."""
    counts = pair_counts(df, label, prediction)
    pivoted = counts.groupBy("label").pivot("prediction", list(classes) if classes else None).agg(F.sum("n"))
    return pivoted.na.fill(0)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def class_counts(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Hits, predictions and support per class. Each pair counts for its label and its prediction."""
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(F.col("label").alias("class"), hit.alias("hits"), F.col("n").alias("support"), zero.alias("predicted")),
        F.struct(F.col("prediction").alias("class"), zero.alias("hits"), zero.alias("support"), F.col("n").alias("predicted")),
    )
    return (
        pairs.select(*by, F.inline(sides))
        .groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("hits", "support", "predicted")])
    )


def per_class_report(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    precision = _ratio(F.col("hits"), F.col("predicted"))
    recall = _ratio(F.col("hits"), F.col("support"))
    scored = class_counts(pairs, by).withColumns({"precision": precision, "recall": recall})
    both = F.col("precision") + F.col("recall")
    return scored.withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"), both))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    Every row is a ratio of two sums over classes. Each class adds its part to its own row and to
    the three summary rows, so one pass over the input and two small aggregates give them all.
    """
    names = ["precision", "recall", "f1"]

    def part(rank: int, row: Column, measures: Sequence[Column], weight: Column) -> Column:
        parts = [measure.cast("double").alias(name) for name, measure in zip(names, measures)]
        return F.struct(
            F.lit(rank).alias("rank"), row.cast("string").alias("class"), *parts,
            weight.cast("double").alias("weight"), F.col("support").alias("support"),
        )

    plain = [F.col(name) for name in names]
    parts = F.array(
        part(0, F.col("class"), plain, F.lit(1)),
        part(1, F.lit("accuracy"), [F.col("hits")] * 3, F.col("support")),
        part(2, F.lit("macro avg"), plain, F.lit(1)),
        part(3, F.lit("weighted avg"), [measure * F.col("support") for measure in plain], F.col("support")),
    )
    report = per_class_report(pair_counts(df, label, prediction)).select(F.inline(parts))
    ratios = [(F.sum(name) / F.sum("weight")).alias(name) for name in names]
    summed = report.groupBy("rank", "class").agg(*ratios, F.sum("support").alias("support"))
    return summed.orderBy("rank", "class").drop("rank")


def f1_and_test_error(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Weighted F1, its complement and the accuracy, each under its own name."""
    report = per_class_report(pair_counts(df, label, prediction))
    f1 = F.sum(F.col("f1") * F.col("support")) / F.sum("support")
    return report.agg(
        f1.alias("f1"), (1 - f1).alias("test_error"), (F.sum("hits") / F.sum("support")).alias("accuracy")
    )


def f1_by(df: DataFrame, by: Sequence[str], label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Weighted F1 of each group."""
    report = per_class_report(pair_counts(df, label, prediction, by), by)
    return report.groupBy(*by).agg((F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"))
