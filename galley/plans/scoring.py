"""Batch scoring of pages against the history of earlier predictions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.functions import language
from galley.functions.text import extract_article_text, extract_table_text, is_blank
from galley.operators.filters import request_status
from galley.plans.model import Model, score
from galley.plans.normalize import cleaned_text
from galley.session import evaluate_once


def extract_requests(pages: DataFrame) -> DataFrame:
    """``(url, summary, status)`` of raw pages ``(url, html)``; tables win over article elements."""
    table_text = extract_table_text(F.col("html"))
    body = F.when(table_text != "", table_text).otherwise(extract_article_text(F.col("html")))
    texts = evaluate_once(pages.select("url", "html"), summary=body).select("url", "summary")
    return texts.withColumn("status", request_status(F.col("url"), F.col("summary")))


def classify_requests(
    requests: DataFrame,
    model: Model,
    predicted_at: datetime | None = None,
    lang: str | None = None,
    min_score: float = 0.9,
    **clean_options,
) -> DataFrame:
    """One answer per request: ``(url, category, predicted_at, summary, status)``.

    ``status`` is ``classified``, or why there is no category: ``invalid`` (no address or no text),
    ``foreign`` (not of language ``lang``, if one is asked for) or ``empty`` (nothing left after
    cleaning). Nothing is dropped. With a ``PipelineModel`` it works on streams, too.
    """
    stamp = F.current_timestamp() if predicted_at is None else F.lit(predicted_at)
    is_valid = F.col("status") == "valid"
    guess = F.lit(None) if lang is None else language.detect_lang(F.col("summary"), language.built_in_stop_words(), min_score)
    rows = evaluate_once(
        requests,
        lemm_summary=F.when(is_valid, cleaned_text(F.col("summary"), **clean_options)).otherwise(""),
        _lang=F.when(is_valid, guess).cast("string"),
    )
    answer = (
        F.when(~is_valid, "invalid")
        .when(F.lit(lang is not None) & ~F.col("_lang").eqNullSafe(lang), "foreign")
        .when(is_blank(F.col("lemm_summary")), "empty")
        .otherwise("classified")
    )
    scored = score(rows.select("url", "summary", "lemm_summary", answer.alias("status")), model)
    has_class = F.col("status") == "classified"
    return scored.select(
        "url", F.when(has_class, F.col("category")).alias("category"), F.when(has_class, stamp).alias("predicted_at"), "summary", "status"
    )


def pages_to_score(pages: DataFrame, history: DataFrame) -> DataFrame:
    """One page per URL that the history does not know, the one with the smallest hash of its source.

    Only keys and hashes are compared with the history and with each other. The sources move once, dealt by
    key and hash, which also brings equal copies together; the keys to keep, one per new URL, are
    broadcast by the adaptive planner if they are few, and then only their pages move. Pages without
    URL are one URL that no history knows.
    """
    key = F.when(F.col("url").isNull(), "").otherwise(F.concat(F.lit("="), "url"))
    hashed = pages.select(key.alias("_key"), "url", F.xxhash64("html").alias("_hash"), "html")
    firsts = hashed.groupBy("_key").agg(F.min("_hash").alias("_hash"))
    known = history.select(F.concat(F.lit("="), "url").alias("_key"))
    chosen = firsts.join(known, "_key", "left_anti")
    return hashed.join(chosen, ["_key", "_hash"], "left_semi").dropDuplicates(["_key", "_hash"]).select("url", "html")


def score_batch(
    pages: DataFrame, history: DataFrame, model: Model, predicted_at: datetime | None = None, **options
) -> DataFrame:
    """Extract and classify the pages whose URL the history does not know; one row per URL.

    ``append_history`` stores the classified ones.
    """
    return classify_requests(extract_requests(pages_to_score(pages, history)), model, predicted_at, **options)
