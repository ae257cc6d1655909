"""Counts, null counts, top values and column profiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galley.session import materialize


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without a null; written as IS NOT NULL so that it reaches the file scan."""
    return df.filter(reduce(Column.__and__, [F.col(c).isNotNull() for c in columns or df.columns]))


def null_value_count(df: DataFrame) -> DataFrame:
    """``(column_name, null_count)`` of the columns with nulls, from one aggregate over one scan."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns])
    return counts.unpivot([], df.columns, "column_name", "null_count").filter("null_count > 0")


def count_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("count"))


def topic_counts(df: DataFrame, topic: str = "topic") -> DataFrame:
    """Articles per topic, most frequent first."""
    return count_by(df, topic).orderBy(F.desc("count"), topic)


def top_values(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """The ``n`` most frequent values; ties in value order."""
    return count_by(df, column).orderBy(F.desc("count"), column).limit(n)


def average_label(df: DataFrame, topic: str = "topic", label: str = "label") -> DataFrame:
    return df.groupBy(topic).agg(F.avg(label).alias("avg_label"))


def page_sizes(responses: DataFrame) -> DataFrame:
    """Number of articles in each response."""
    return responses.select("*", F.size("articles").cast("bigint").alias("n_articles"))


def _basics(field: T.StructField) -> dict[str, Column]:
    """Measures with small state, whatever the data."""
    column = F.col(f"`{field.name}`")
    return {
        "rows": F.count("*"),
        "nulls": F.count_if(column.isNull()),
        "min": F.min(column).cast("string"),
        "max": F.max(column).cast("string"),
        "avg_length": F.avg(F.length(column.cast("string"))),
    }


def _number(field: T.StructField) -> Column:
    is_number = isinstance(field.dataType, T.NumericType)
    return F.col(f"`{field.name}`").cast("double") if is_number else F.lit(None).cast("double")


MEASURES = ("rows", "nulls", "distinct", "min", "max", "avg_length", "q25", "median", "q75")
QUARTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75}


def _one_row_per_column(df: DataFrame, measures: dict[str, dict[str, Column]]) -> DataFrame:
    """All measures of all columns by one aggregate, then a row for each column."""
    totals = df.agg(*[F.struct(*[m.alias(k) for k, m in ms.items()]).alias(name) for name, ms in measures.items()])
    entries = [
        F.struct(F.lit(name).alias("column_name"), *[F.col(f"`{name}`")[k].alias(k) for k in ms])
        for name, ms in measures.items()
    ]
    return totals.select(F.inline(F.array(*entries)))


def profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """One row per column: rows, nulls, distinct values, extremes, text length and quartiles.

    The default measures all columns by one aggregate of sketches. ``exact`` counts the values of all
    columns in one shuffle and looks the quartiles up in their order; its state is no larger than the
    distinct values of a partition.
    """
    if exact:
        return exact_profile(df)
    measures = {}
    for field in df.schema:
        number = _number(field)
        sketches = {"distinct": F.approx_count_distinct(F.col(f"`{field.name}`"))}
        sketches |= {name: F.percentile_approx(number, q) for name, q in QUARTILES.items()}
        measures[field.name] = {name: (_basics(field) | sketches)[name] for name in MEASURES}
    return _one_row_per_column(df, measures)


#: Longer values are counted by their SHA-256.
LONGEST_VALUE = 64


def value_counts(df: DataFrame) -> DataFrame:
    """``(column, value, number, n)`` of all columns: how often each value occurs, and as a number if it is one.

    ``column`` is the position of the column, ``value`` a text that differs for different values; nulls are
    left out. Equal values are merged in each task first, so a value that fills a third of the rows moves
    once per task.
    """
    def entry(position: int, field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            column = F.when(column == 0, F.lit(0.0)).otherwise(column)
        atomic = not isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))
        text = column.cast("string") if atomic else F.base64(column) if isinstance(field.dataType, T.BinaryType) else F.to_json(F.struct(column))
        short = F.when(F.octet_length(text) <= LONGEST_VALUE, F.concat(F.lit("="), text)).otherwise(F.sha2(text, 256))
        return F.struct(F.lit(position).alias("column"), F.when(column.isNotNull(), short).alias("value"), _number(field).alias("number"))

    cells = df.select(F.inline(F.array(*[entry(i, field) for i, field in enumerate(df.schema)]))).where("value IS NOT NULL")
    return cells.groupBy("column", "value", "number").agg(F.count("*").alias("n"))


def exact_profile(df: DataFrame) -> DataFrame:
    """``profile`` with exact distinct counts and interpolated quartiles, for tables of any size.

    The counted numbers of all columns are sorted over range partitions. Each partition's total per column
    gives the rank of its first number, and a quartile is the value whose ranks span its position: at most
    six rows per column are left then. Not-a-number values count as the greatest.
    """
    fields = list(df.schema)
    basics = _one_row_per_column(df, {field.name: _basics(field) for field in fields})
    counts = materialize(value_counts(df), "value_counts")
    sizes = counts.groupBy("column").agg(F.count("*").alias("distinct"), F.sum("n").alias("values"))
    names = F.array(*[F.lit(field.name) for field in fields])
    quartiles = order_statistics(counts.where("number IS NOT NULL").select("column", "number", "n"), QUARTILES)
    found = sizes.join(quartiles, "column", "left").withColumn("column_name", F.get(names, F.col("column")))
    none = {name: F.lit(None).cast("double") for name in QUARTILES if name not in found.columns}
    found = found.withColumns(none).select("column_name", "distinct", *QUARTILES)
    rows = F.broadcast(basics).join(F.broadcast(found), "column_name", "left")  # one row per column of the schema
    return rows.select("column_name", *[F.coalesce("distinct", F.lit(0)).alias("distinct") if m == "distinct" else F.col(m) for m in MEASURES])


def order_statistics(counts: DataFrame, shares: dict[str, float]) -> DataFrame:
    """Interpolated quantiles of each ``column`` of ``(column, number, n)``, n times the number: one row per column."""
    order = [F.col("column"), F.col("number")]
    placed = counts.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    placed = materialize(placed, "ordered")
    parts = placed.groupBy("column", "_part").agg(F.sum("n").alias("in_part"))
    earlier = Window.partitionBy("column").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("column")
    # One row per partition and column that meet.
    parts = parts.select("column", "_part", F.coalesce(F.sum("in_part").over(earlier), F.lit(0)).alias("first"), F.col("in_part"), F.sum("in_part").over(whole).alias("total"))
    ranks = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(share).alias("share")) for name, share in shares.items()])
    wanted = parts.select("*", F.inline(ranks)).withColumn("position", F.col("share") * (F.col("total") - 1))
    ends = F.array(F.floor("position"), F.ceil("position"))
    wanted = wanted.withColumn("rank", F.explode(F.array_distinct(ends))).where("rank >= first AND rank < first + in_part")
    wanted = wanted.select("column", "_part", "name", "position", (F.col("rank") - F.col("first")).alias("within"), "rank")
    # Only partitions that hold a wanted rank are numbered, each by itself.
    near = placed.join(F.broadcast(wanted.select("column", "_part").distinct()), ["column", "_part"], "left_semi")
    before = Window.partitionBy("column", "_part").orderBy("number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = near.withColumn("upto", F.sum("n").over(before))
    hits = near.join(F.broadcast(wanted), ["column", "_part"]).where("within >= upto - n AND within < upto")
    low = F.min_by("number", "rank")
    value = low + (F.max_by("number", "rank") - low) * (F.first("position") - F.floor(F.first("position")))
    return hits.groupBy("column").pivot("name", list(shares)).agg(value) if len(shares) > 1 else hits.groupBy("column").agg(value.alias(next(iter(shares))))


def profile_top_values(df: DataFrame, columns: Sequence[str], n: int = 5) -> DataFrame:
    """The most frequent values of each column as ``(column_name, value, count)``."""
    tops = [
        top_values(df.select(F.col(c).cast("string").alias("value")), "value", n).select(
            F.lit(c).alias("column_name"), "value", "count"
        )
        for c in columns
    ]
    return reduce(DataFrame.unionByName, tops)
