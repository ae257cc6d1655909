"""Label index, split, term counts, TF-IDF and vectors."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, HashingTF, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from galley.operators.skew import joined_by_term
from galley.session import materialize

def index_labels(df: DataFrame, topic: str = "topic", label: str = "label") -> DataFrame:
    """Class index by frequency, ties alphabetical; a missing topic is an error."""
    return StringIndexer(inputCol=topic, outputCol=label).fit(df).transform(df)


def split_bucket(key: Column) -> Column:
    """0 to 99 from the content of the key, the same on every run and under any partitioning."""
    return (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % 100).cast("int")


def split(df: DataFrame, key: Column, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Disjoint, exhaustive training and test frames."""
    bucket = split_bucket(key)
    return df.filter(bucket < percent), df.filter(bucket >= percent)


_COUNTS = ArrayType(StructType([StructField("term", StringType()), StructField("tf", LongType())]))


@F.arrow_udf(_COUNTS)
def _counted(tokens: pa.Array) -> pa.Array:
    # Rows and terms as numbers: one sort counts a whole batch. Terms are ranked first, so rows come out in term order.
    words = tokens.flatten().dictionary_encode("encode")
    order = pc.sort_indices(words.dictionary, null_placement="at_start").to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(tokens)), sizes)
    pairs, tf = np.unique(rows * max(1, len(order)) + rank[words.indices.to_numpy()], return_counts=True)
    row, term = np.divmod(pairs, max(1, len(order)))
    ends = np.searchsorted(row, np.arange(len(tokens) + 1)).astype(np.int32)
    entries = [words.dictionary.take(pa.array(order[term])).cast(pa.string()), pa.array(tf.astype(np.int64))]
    found = pa.StructArray.from_arrays(entries, ["term", "tf"])
    return pa.ListArray.from_arrays(pa.array(ends), found, mask=pa.array(sizes == 0))


def row_term_counts(tokens: Column | str) -> Column:
    """Array of ``(term, tf)`` of the row's tokens, in term order; null without tokens. No token leaves its row."""
    return _counted(tokens)


def vocabulary_counts(df: DataFrame, tokens: Column | str) -> DataFrame:
    """Occurrences and document frequency of each term.

    Each row brings every term once with its count, so the only shuffle is the one by term, behind
    partial sums.
    """
    return (
        df.select(F.inline(row_term_counts(tokens)))
        .groupBy("term")
        .agg(F.sum("tf").alias("tf"), F.count("*").alias("df"))
    )


def document_frequencies(counts: DataFrame) -> DataFrame:
    return counts.groupBy("term").agg(F.count("*").alias("df"))


def inverse_frequency(n_documents: Column, df: Column, min_doc_freq: int) -> Column:
    """``ln((N + 1) / (df + 1))``, 0 for terms in fewer than ``min_doc_freq`` documents."""
    return F.when(df >= min_doc_freq, F.ln((n_documents + 1) / (df + 1))).otherwise(F.lit(0.0))


def tf_idf(df: DataFrame, key: str, tokens: Column, min_doc_freq: int = 3) -> DataFrame:
    """``(key, term, tf, df, tf_idf)`` with exact terms instead of hash buckets; one row per key.

    Terms are counted within their row. The pairs are read several times, so they are written once, and so
    are the frequencies. A term that stands in many documents joins its frequency without a shuffle.
    """
    n_documents = df.agg(F.count("*")).scalar()
    counts = materialize(df.select(key, F.inline(row_term_counts(tokens))), "term_counts")
    frequencies = materialize(document_frequencies(counts), "frequencies")
    idf = inverse_frequency(n_documents, F.col("df"), min_doc_freq)
    joined = joined_by_term(counts, frequencies, counted="df")
    return joined.select(key, "term", "tf", "df", (F.col("tf") * idf).alias("tf_idf"))


def vocabulary_size(df: DataFrame, tokens: str) -> int:
    """Number of distinct terms, so that a vocabulary of this size drops none."""
    return max(1, df.select(F.explode(tokens).alias("term")).agg(F.count_distinct("term")).first()[0])


def count_vectorizer(df: DataFrame, tokens: str, output: str, min_df: float = 1.0) -> CountVectorizerModel:
    """Exact term counts as a pipeline stage. The vocabulary holds every term; it is part of the model and so
    reaches the driver, where hash buckets stay bounded and ``terms.term_vectors`` keeps a table."""
    size = vocabulary_size(df, tokens)
    return CountVectorizer(inputCol=tokens, outputCol=output, vocabSize=size, minDF=min_df).fit(df)


def hashed_counts(df: DataFrame, tokens: str, output: str = "features", num_features: int = 1 << 18) -> DataFrame:
    return HashingTF(inputCol=tokens, outputCol=output, numFeatures=num_features).transform(df)


def vector_entries(df: DataFrame, vector: str, key: Sequence[str] = ()) -> DataFrame:
    """Non-zero entries ``(index, value)`` of a sparse vector column."""
    parsed = F.from_json(
        F.to_json(F.struct(F.col(vector).alias("v"))), "v struct<indices:array<int>,values:array<double>>"
    )
    entries = df.select(*key, parsed["v"].alias("v"))
    return entries.select(*key, F.inline(F.arrays_zip(F.col("v.indices").alias("index"), F.col("v.values").alias("value"))))
