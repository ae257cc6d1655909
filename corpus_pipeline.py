"""Training-data pipeline: documents in, token ids out.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. All but the last
return the columns of ``docs``; a column ``n_chars`` follows the text where a stage cuts it. Stages define
their results for nulls, empty texts, repeated rows and empty tables as their operators do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galley.llm import bpe, decontaminate, near_dup, suffix_dedup, toxicity
from galley.llm.common import ship, table
from galley.llm.queries import tokenizer_path
from galley.session import materialize

#: Words of a passage that is removed if an earlier document holds it, and of a benchmark window.
PASSAGE_WORDS = 50
WINDOW_WORDS = 10


def _recounted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.remove_toxic(docs, model)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest id, of each group of near copies."""
    ship(spark)
    return near_dup.keep_one(docs, k=5, percent=80)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document of a smaller id holds as well."""
    ship(spark)
    return _recounted(suffix_dedup.remove_repeated(docs, length=PASSAGE_WORDS))


def remove_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of benchmark items."""
    return _recounted(decontaminate.remove_spans(docs, table(spark, sf_dir, "benchmark"), n=WINDOW_WORDS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and the digests of the ids and of the text decoded from them."""
    ship(spark)
    tokens = bpe.encode(docs, tokenizer_path("word_bpe_49k.json"), columns=["doc_id"], as_bytes=True, decoded="decoded")
    return tokens.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", remove_toxic),
    ("near_dedup", remove_near_duplicates),
    ("suffix_dedup", remove_repeated_passages),
    ("decontamination", remove_benchmark_passages),
    ("bpe", encode),
]

#: Trained scores, sets and merges are beyond SQL; the tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
