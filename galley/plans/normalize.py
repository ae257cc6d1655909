"""The normalization chain for training and prediction texts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galley.functions import language, lexical, text
from galley.functions.words import ENGLISH_STOP_WORDS
from galley.operators.profile import drop_null_rows
from galley.session import evaluate_once


def cleaned_text(column: Column, compat: bool = False, lexicon: lexical.Lexicon = lexical.ENGLISH) -> Column:
    """The chain on one text; what cleans to nothing is the empty string."""
    if compat:
        # The extra spaces that compat cleaning leaves make no difference to the words behind it.
        words = text.feature_words(text.remove_stop_words(column))
    else:
        words = text.feature_words(text.strip_non_ascii(column))
    return F.array_join(lexical.lemmatize_kept(words, () if compat else ENGLISH_STOP_WORDS, lexicon), " ")


def normalize(
    df: DataFrame,
    text_col: str = "summary",
    keep: Sequence[str] = ("topic",),
    compat: bool = False,
    lang: str | None = "en",
    word_lists: Mapping[str, Sequence[str]] | None = None,
    min_score: float = 0.9,
    lexicon: lexical.Lexicon = lexical.ENGLISH,
    dedup: bool = True,
) -> DataFrame:
    """Clean ``text_col`` into ``lemm_summary`` and keep the columns ``keep``.

    Default order: drop nulls, keep rows of language ``lang`` (None keeps all), strip non-ASCII,
    remove features, remove stop words, keep nouns, adjectives and verbs, lemmatize, drop blanks,
    deduplicate. ``compat`` removes stop words case-sensitively before lower-casing, keeps every
    language and non-ASCII text, and treats only white space, not the empty string, as blank.

    Everything up to the last step is one narrow projection. Deduplication groups on the output
    columns, so each task merges its own copies before the one shuffle.
    """
    rows = drop_null_rows(df.select(*keep, F.col(text_col).alias("_text")))
    if lang is not None and not compat:
        lists = word_lists or language.built_in_stop_words()
        rows = evaluate_once(rows, found_lang=language.detect_lang(F.col("_text"), lists, min_score))
        rows = rows.filter(F.col("found_lang") == lang)
    cleaned = evaluate_once(rows, lemm_summary=cleaned_text(F.col("_text"), compat, lexicon))
    cleaned = cleaned.select(*keep, "lemm_summary").filter(~text.is_blank(F.col("lemm_summary"), compat))
    return cleaned.dropDuplicates([*keep, "lemm_summary"]) if dedup else cleaned


def normalize_for_prediction(df: DataFrame, text_col: str = "summary", **options) -> DataFrame:
    """The same chain without a topic; only the distinct cleaned texts remain."""
    return normalize(df, text_col, keep=(), **options)


def cleaned_articles(df: DataFrame, text_col: str = "text", keep: Sequence[str] = ("lang",)) -> DataFrame:
    """The short chain for any language: features, stop words, blanks, duplicates."""
    words = text.drop_words(text.feature_words(F.col(text_col)), ENGLISH_STOP_WORDS)
    cleaned = evaluate_once(drop_null_rows(df.select(*keep, text_col)), clean_text=F.array_join(words, " "))
    return cleaned.select(*keep, "clean_text").filter(~text.is_blank(F.col("clean_text"))).dropDuplicates([*keep, "clean_text"])
