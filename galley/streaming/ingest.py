"""Ingest of polled API responses: store every article once, publish the allow-listed topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from galley import schemas
from galley.functions.records import parse_published
from galley.session import evaluate_once, materialize
from galley.sources.articles import flatten_api_articles
from galley.sources.sinks import topic_records


def response_stream(spark: SparkSession, landing: str, **options: str) -> DataFrame:
    """Landed API responses as a stream of articles."""
    return flatten_api_articles(spark.readStream.schema(schemas.API_RESPONSE).options(**options).json(landing))


def arrival_stream(spark: SparkSession, landing: str, delay: str = "0 seconds", **options: str) -> DataFrame:
    """Landed API responses as a stream of articles with the time of ``arrived``, on which a watermark follows.

    The time is that of the landing folder (``arrived=<timestamp>``). A response without articles moves the
    watermark as well, so an idle feed is closed by an empty poll.
    """
    schema = StructType([*schemas.API_RESPONSE.fields, StructField("arrived", TimestampType())])
    responses = spark.readStream.schema(schema).options(**options).json(landing).withWatermark("arrived", delay)
    # the outer form leaves responses without articles in until the watermark has seen them
    exploded = responses.select("arrived", F.explode_outer("articles").alias("article")).where("article IS NOT NULL")
    return exploded.select(
        "arrived", *[F.col(f"article.{'link' if name == 'source' else name}").alias(name) for name in schemas.ARTICLE.fieldNames()]
    )


def dated(articles: DataFrame) -> DataFrame:
    """Articles with the parsed ``published_at``."""
    return evaluate_once(articles, published_at=parse_published(F.col("published_date")))


def dedup_articles(articles: DataFrame, key: str = "source", delay: str = "7 days", salts: int = 8) -> DataFrame:
    """One article per key among those that arrive within ``delay`` of each other: the one that arrives first.

    It is passed on at once; ``first_published`` waits for the copy published first.

    The watermark follows the time of arrival, not the published date. It bounds the state, and as
    no row arrives late, old and undated articles are kept. Copies are removed per salted key first,
    so that a source sent over and over is spread over ``salts`` tasks; the few survivors meet in
    the second step. The salt is that of the task that read the copy, so one task's copies leave one survivor.
    """
    unique = articles.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", delay)
    if salts > 1:
        salted = unique.withColumn("_salt", F.spark_partition_id() % salts)
        unique = salted.dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt")
    return unique.dropDuplicatesWithinWatermark([key]).drop("_arrived")


def _first_copy(articles: DataFrame, *others: str) -> Column:
    """The copy published first, ties by content; undated copies come last."""
    rest = [c for c in articles.columns if c not in others]
    return F.min(F.struct(F.col("published_at").isNull().alias("undated"), "published_at", *[c for c in rest if c != "published_at"])).alias("first")


def batch_dedup(articles: DataFrame, key: str = "source", columns: Sequence[str] | None = None) -> DataFrame:
    """The batch form: the first published copy of each key, ties by content; all columns or the named ones.

    Texts that are not asked for move as digests, which tell whether the copies that tie up to them are the
    same in them. Only copies of keys where they differ are compared whole.
    """
    if columns is None:
        return _first_copies(articles, key)
    kept = list(columns)
    unasked = [f.name for f in articles.schema.fields if isinstance(f.dataType, StringType) and f.name not in (*kept, key)]
    if not unasked:
        return _first_copies(articles, key).select(*kept)
    content = F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in unasked])
    # The digest stands where the first of these texts stood: what is before it decides alone, and what is
    # behind it only between copies that agree in all of them.
    rest = [c for c in articles.columns if c != "published_at" and c != key]
    before = rest[: min(map(rest.index, unasked))]
    hashed = evaluate_once(articles, _digest=F.sha2(content, 256)).drop(*unasked)
    order = [F.col("published_at").isNull().alias("undated"), "published_at", *before]
    behind = [c for c in rest if c not in (*before, *unasked)]
    # the greatest digest is the least one with its digits turned around
    turned = F.translate("_digest", "0123456789abcdef", "fedcba9876543210")
    least = F.min(F.struct(*order, "_digest", *behind)).alias("first")
    greatest = F.min(F.struct(*order, turned.alias("turned"))).alias("other")
    differs = F.translate("other.turned", "0123456789abcdef", "fedcba9876543210") != F.col("first._digest")
    first = hashed.groupBy(key).agg(least, greatest).select(key, "first.*", differs.alias("_differs"))
    found = materialize(first.select(*kept, *([] if key in kept else [key]), "_differs"), "first_copies")
    agreed = found.where("NOT _differs").select(*kept)
    if found.where("_differs").isEmpty():
        return agreed
    unclear = materialize(found.where("_differs").select(key), "unclear")
    whole = articles.join(unclear, articles[key].eqNullSafe(unclear[key]), "left_semi")
    return agreed.unionByName(_first_copies(whole, key).select(*kept))


def _first_copies(articles: DataFrame, key: str) -> DataFrame:
    return articles.groupBy(key).agg(_first_copy(articles, key)).select(key, "first.*").drop("undated")


def first_published(articles: DataFrame, key: str = "source", gap: str = "7 days") -> DataFrame:
    """The copy of each key published first among those that arrive within ``gap`` of the one before.

    The batch form on a stream: copies wait as one small state per key, the earliest so far, and the result
    is emitted when the watermark on ``arrived`` shows that no copy came for ``gap``. What counts is the time of
    arrival, so old and undated articles are not late. A source sent over and over is merged in each task
    before it moves (``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition``).
    """
    sessions = articles.groupBy(key, F.session_window("arrived", gap)).agg(_first_copy(articles, key, "arrived"))
    return sessions.select(key, "first.*").drop("undated")


def ingest_stream(
    articles: DataFrame,
    stored: str,
    published: str,
    topics: Sequence[str],
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write every article and the records of the allow-listed topics.

    Each micro-batch owns one folder per output and replaces it when it is run again, so a restart
    after a failure neither loses nor repeats articles. The records are made from the stored rows,
    which saves a second run of the batch.
    """
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        folder = f"{stored}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(folder)
        rows = batch.sparkSession.read.schema(batch.schema).parquet(folder)
        topic_records(rows, topics).write.mode("overwrite").partitionBy("topic").text(f"{published}/batch_id={batch_id}")

    writer = articles.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def reject_stream(articles: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Articles whose date cannot be parsed, for collections that need one."""
    rejected = articles.filter(F.col("published_at").isNull()).drop("published_at")
    writer = rejected.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
