"""Readers for labelled, raw and streamed articles and for the prediction history."""

from __future__ import annotations

import csv
from collections.abc import Iterable
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from galley import schemas

CORRUPT = "_corrupt_record"


def _files_by_header(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files of each layout. Only the first line of each file reaches the driver, as its name does anyway."""
    # All lines of a file's first split are in one partition, in order.
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    first = lines.where("file_block_start = 0").groupBy("file_path").agg(F.first("value").alias("header"))
    layouts: dict[tuple[str, ...], list[str]] = {}
    for row in first.orderBy("file_path").collect():
        names = next(csv.reader([row.header.removeprefix("\ufeff")]), [])
        layouts.setdefault(tuple(name.strip() for name in names), []).append(unquote(row.file_path))
    return layouts


def _read_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool) -> DataFrame:
    """Columns of ``schema`` by the names in each file's own header, in any order and case, plus the corrupt text.

    A file whose header lacks a column is an error.
    """
    # Quotes inside a field are doubled. Fields may hold line breaks, so files are read whole;
    # collections without line breaks can set multi_line=False to have large files split.
    reader = spark.read.options(header=True, quote='"', escape='"', multiLine=multi_line)
    reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    names = [*schema.fieldNames(), CORRUPT]
    parts = []
    for header, files in _files_by_header(spark, path).items():
        if lacking := {n.lower() for n in schema.fieldNames()} - {n.lower() for n in header}:
            raise ValueError(f"no column {sorted(lacking)} in {files[:3]}")
        fields = StructType([StructField(name, StringType()) for name in [*header, CORRUPT]])
        parts.append(reader.schema(fields).csv(files).select(*[F.col(name).alias(name) for name in names]))
    empty = StructType([StructField(name, StringType()) for name in names])
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], empty)


def read_articles(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Labelled articles ``topic,title,summary`` from CSV with a header; bad rows keep their text."""
    return _read_csv(spark, path, schemas.LABELLED_ARTICLE, multi_line)


def read_summaries(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Unlabelled texts ``summary`` from CSV with a header."""
    return _read_csv(spark, path, schemas.SUMMARY, multi_line)


def read_collection(
    spark: SparkSession, fmt: str, schema: StructType | None = schemas.ARTICLE, **options: str
) -> DataFrame:
    """A stored collection through any data source; ``path`` or connector settings are options."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load()


def read_history(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    return read_collection(spark, fmt, schemas.HISTORY, path=path, **options)


def read_api_responses(spark: SparkSession, path: str) -> DataFrame:
    """Landed API responses, one JSON object per line."""
    return spark.read.schema(schemas.API_RESPONSE).json(path)


def flatten_api_articles(responses: DataFrame) -> DataFrame:
    """One row per article of each response; ``link`` becomes ``source``. Works on streams too."""
    articles = responses.select(F.explode("articles").alias("article"))
    return project_article(articles.select("article.*"))


def project_article(df: DataFrame) -> DataFrame:
    return df.select("title", "published_date", "summary", "topic", F.col("link").alias("source"))


def read_rss(spark: SparkSession, path: str, topic: str = "news") -> DataFrame:
    """RSS items as articles of one constant topic, still with ``link``."""
    items = spark.read.format("xml").option("rowTag", "item").schema(schemas.RSS_ITEM).load(path)
    return items.select(
        "title",
        F.col("pubDate").alias("published_date"),
        F.col("description").alias("summary"),
        F.lit(topic).alias("topic"),
        "link",
    )


def read_article_stream(
    spark: SparkSession, fmt: str = "kafka", schema: StructType | None = None, **options: str
) -> DataFrame:
    """Records ``(topic, value)`` from the earliest offset on.

    Kafka needs its connector on the class path. Any file format with the two columns works the
    same way when a schema is given.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("startingOffsets", "earliest")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).load().select("topic", F.col("value").cast("string").alias("value"))


def articles_from_strings(spark: SparkSession, texts: Iterable[str]) -> DataFrame:
    """A few texts typed in by a caller as a frame with one column ``summary``."""
    return spark.createDataFrame([(text,) for text in texts], schemas.SUMMARY)
