"""Exploration and bag-of-words jobs over a collection of articles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.functions.text import remove_digits
from galley.operators import features, profile
from galley.operators.terms import term_vectors


@dataclass(frozen=True)
class Exploration:
    null_counts: DataFrame
    row_count: DataFrame
    topics: DataFrame
    titles: DataFrame


def explore(articles: DataFrame) -> Exploration:
    """Null counts of the raw columns; counts, topics and top titles of the complete rows."""
    raw = articles.select("title", "summary", "topic")
    complete = profile.drop_null_rows(raw)
    return Exploration(
        null_counts=profile.null_value_count(raw),
        row_count=profile.row_count(complete),
        topics=profile.topic_counts(complete),
        titles=profile.top_values(complete, "title", 20),
    )


def title_words(articles: DataFrame) -> DataFrame:
    """Titles without digits, as tokens and as tokens without stop words."""
    complete = profile.drop_null_rows(articles, ["title", "summary", "topic"])
    stripped = complete.withColumn("only_str", remove_digits(F.col("title")))
    tokens = RegexTokenizer(inputCol="only_str", outputCol="words", pattern="\\W").transform(stripped)
    return StopWordsRemover(inputCol="words", outputCol="filtered").transform(tokens)


def bag_of_words(articles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Training and test frames with ``categoryIndex`` and the counts of the title words by dictionary index."""
    words = title_words(articles)
    indexed = features.index_labels(words, label="categoryIndex")
    _, vectors = term_vectors(indexed, "filtered")
    return features.split(vectors, F.concat_ws("\x1f", "topic", "title", "summary"))
