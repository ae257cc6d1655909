"""Writers for collections, broker topics and relational tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.functions.records import to_record


def append_collection(df: DataFrame, path: str, fmt: str = "parquet", **options: str) -> None:
    df.write.mode("append").format(fmt).options(**options).save(path)


def topic_records(df: DataFrame, topics: Sequence[str]) -> DataFrame:
    """``(topic, value)`` of the allow-listed rows, with the whole row as JSON."""
    return df.filter(F.col("topic").isin(*topics)).select("topic", to_record(df).alias("value"))


def publish_by_topic(df: DataFrame, topics: Sequence[str], path: str | None = None, **broker: str) -> None:
    """Send the allow-listed rows to the broker topic named by their ``topic``.

    With ``path`` the records go to one folder per topic instead of a broker. Writing needs no
    shuffle: each task adds one file to each topic it holds.
    """
    records = topic_records(df, topics)
    if path is None:
        records.write.format("kafka").options(**broker).save()
    else:
        records.write.mode("append").partitionBy("topic").text(path)


def write_table(df: DataFrame, name: str, mode: str = "error", path: str | None = None) -> None:
    """Create or extend a catalog table; the mode says what happens to an existing one."""
    writer = df.write.mode(mode).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    df.write.mode(mode).format("jdbc").options(url=url, dbtable=table, **options).save()
