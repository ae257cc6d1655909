"""Explicit schemas; nothing in the package relies on inference."""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


LABELLED_ARTICLE = _strings("topic", "title", "summary")
SUMMARY = _strings("summary")
ARTICLE = _strings("title", "published_date", "summary", "topic", "source")
API_ARTICLE = _strings("title", "published_date", "summary", "topic", "link")
API_RESPONSE = T.StructType([
    T.StructField("articles", T.ArrayType(API_ARTICLE)),
    T.StructField("page_size", T.LongType()),
])
RSS_ITEM = _strings("title", "description", "link", "pubDate")
BROKER_RECORD = _strings("topic", "value")
HISTORY = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("predicted_at", T.TimestampType()),
    T.StructField("summary", T.StringType()),
])
RETRAIN_LOG = T.StructType([T.StructField("last_trained_at", T.TimestampType())])
