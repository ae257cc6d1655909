"""JSON records, dates and small scalar helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from galley.schemas import ARTICLE

# The two date layouts of news feeds. The weekday of RSS dates is cut off first.
DATE_LAYOUT = "yyyy-MM-dd HH:mm:ss"
RSS_DATE_LAYOUT = "dd MMM yyyy HH:mm:ss z"


def to_record(df: DataFrame) -> Column:
    """The whole row as JSON; null fields are kept as null."""
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})


def decode_records(df: DataFrame, value: str = "value", schema: StructType = ARTICLE) -> DataFrame:
    """Parsed ``record`` next to the raw text; ``is_valid`` is false for anything but an object."""
    corrupt = "_corrupt_record"
    parsed = F.from_json(
        F.col(value), StructType([*schema.fields, StructField(corrupt, StringType())]),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt},
    )
    rows = df.withColumn("record", parsed)
    is_valid = F.col("record").isNotNull() & F.col(f"record.{corrupt}").isNull()
    fields = F.struct(*[F.col(f"record.{name}").alias(name) for name in schema.fieldNames()])
    return rows.withColumns({"is_valid": is_valid, "record": fields})


def parse_published(text: Column) -> Column:
    """Timestamp of either layout, null when neither fits."""
    without_weekday = F.regexp_replace(text, "^[A-Za-z]{3}, ", "")
    return F.coalesce(
        F.try_to_timestamp(text, F.lit(DATE_LAYOUT)),
        F.try_to_timestamp(without_weekday, F.lit(RSS_DATE_LAYOUT)),
    )


def class_name(index: Column, names: Sequence[str]) -> Column:
    """Name of a class index, null outside the range."""
    return F.get(F.array(*[F.lit(name) for name in names]), index.cast("int"))


def error_rate(metric: Column) -> Column:
    return 1 - metric
