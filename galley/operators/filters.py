"""Filters and lookups over articles and requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galley.functions import text


def in_topics(df: DataFrame, topics: Sequence[str], column: str = "topic") -> DataFrame:
    return df.filter(F.col(column).isin(*topics))


def in_language(df: DataFrame, lang: str, column: str = "lang") -> DataFrame:
    return df.filter(F.col(column) == lang)


def without_blanks(df: DataFrame, column: str, compat: bool = False) -> DataFrame:
    return df.filter(~text.is_blank(F.col(column), compat))


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def request_status(url: Column, body: Column) -> Column:
    """``valid`` for a URL with extracted text, else ``invalid``."""
    has_url = F.coalesce(url, F.lit("")) != ""
    has_text = F.coalesce(body, F.lit("")) != ""
    return F.when(has_url & has_text, "valid").otherwise("invalid")


def search_articles(df: DataFrame, query: str, lang: str, text_col: str = "summary", lang_col: str = "lang") -> DataFrame:
    """Articles of a language whose text holds the query, ignoring case."""
    return df.filter((F.col(lang_col) == lang) & F.contains(F.lower(text_col), F.lit(query.lower())))


def distinct_texts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of the columns. Copies merge within each task before the shuffle."""
    return df.select(*columns).distinct()
