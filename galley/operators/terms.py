"""A dictionary of terms as a table, and count vectors over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galley.operators.features import row_term_counts
from galley.operators.skew import joined_by_term
from galley.session import materialize

_POSITION_BITS = 33


def numbered_rows(df: DataFrame, name: str, id_column: str = "_row") -> DataFrame:
    """``df`` with a number for each row, written once so that the numbers stay."""
    return materialize(df.withColumn(id_column, F.monotonically_increasing_id()), name)


def term_pairs(df: DataFrame, key: str, tokens: Column | str) -> DataFrame:
    """``(key, term, tf)`` of every row, written once as several passes read it."""
    return materialize(df.select(key, F.inline(row_term_counts(tokens))), "term_pairs")


def dictionary(pairs: DataFrame, min_df: int = 1) -> DataFrame:
    """``(term, index, tf, df)``: terms numbered from 0, most frequent first, ties in term order.

    Terms are sorted over range partitions and numbered inside them; the first number of a partition is
    the total of those before it. Only these totals, one per partition, meet in one place.
    """
    counts = pairs.groupBy("term").agg(F.sum("tf").alias("tf"), F.count("*").alias("df")).where(F.col("df") >= min_df)
    order = [F.desc("tf"), F.asc("term")]
    placed = counts.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    stored = materialize(placed, "dictionary").withColumn("_part", F.shiftright("_at", _POSITION_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.groupBy("_part").agg(F.count("*").alias("n"))
    firsts = sizes.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    position = F.col("_at").bitwiseAND((1 << _POSITION_BITS) - 1)
    return stored.join(F.broadcast(firsts), "_part").select("term", (F.col("_first") + position).alias("index"), "tf", "df")


def term_vectors(
    df: DataFrame, tokens: Column | str, output: str = "features", min_df: int = 1, key: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """The dictionary of ``df``'s tokens, and ``df`` with its counts as ``array<struct<index, value>>``.

    The arrays are sorted by index and hold one entry per term of the row: a sparse vector as long as the
    dictionary, which may hold more terms than a driver or a vector's 32-bit size can. With ``key``, a column
    unique by row, ``df`` is not written; else its rows are numbered and written once.
    """
    rows, row = (df, key) if key else (numbered_rows(df, "rows"), "_row")
    pairs = term_pairs(rows, row, tokens)
    words = materialize(dictionary(pairs, min_df), "words")
    entry = F.struct("index", F.col("tf").cast("double").alias("value"))
    coded = joined_by_term(pairs, words.select("term", "index", "df"), counted="df")
    vectors = coded.groupBy(row).agg(F.array_sort(F.collect_list(entry)).alias(output))
    empty = F.array().cast("array<struct<index:bigint,value:double>>")
    return words, rows.join(vectors, row, "left").select(*df.columns, F.coalesce(output, empty).alias(output))
