"""Word lists as tables, from files in the public corpus formats."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galley.functions.language import built_in_stop_words
from galley.functions.lexical import Lexicon


def word_lists(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Distinct ``(lang, word)``: one file per language named after it, one word per line.

    Without a path the built-in lists are returned under their ISO codes.
    """
    if path is None:
        rows = [(lang, word) for lang, words in built_in_stop_words().items() for word in words]
        return spark.createDataFrame(rows, "lang string, word string")
    lines = spark.read.text(path).select(
        F.element_at(F.split(F.input_file_name(), "/"), -1).alias("lang"), F.trim("value").alias("word")
    )
    return lines.filter(F.col("word") != "").distinct()


def lemma_exceptions(spark: SparkSession, path: str, pos: str) -> DataFrame:
    """``(pos, form, lemma)`` from a file of lines ``form lemma``; extra lemmas are ignored."""
    parts = F.split(F.trim("value"), " +")
    pairs = spark.read.text(path).select(F.lit(pos).alias("pos"), parts[0].alias("form"), F.get(parts, F.lit(1)).alias("lemma"))
    return pairs.filter(F.col("lemma").isNotNull())


def indexed_words(spark: SparkSession, path: str) -> DataFrame:
    """Head words of an index file; its licence lines start with blanks."""
    lines = spark.read.text(path).filter(~F.col("value").startswith(" "))
    return lines.select(F.element_at(F.split("value", " "), 1).alias("word")).filter("word <> ''")


def write_exceptions(spark: SparkSession, table: Mapping[str, str], path: str) -> None:
    """A lemma table as a file of lines ``form lemma``."""
    spark.createDataFrame(list(table.items()), "form string, lemma string").select(F.concat_ws(" ", "form", "lemma")).coalesce(1).write.text(path)


def read_lexicon(spark: SparkSession, verb_exceptions: str, noun_exceptions: str, verb_index: str | None = None) -> Lexicon:
    """Load lemma tables into plan literals, refusing more rows than a lexicon may hold.

    Tables of any size stay tables: ``operators.lemmas.lemmatize_by_table`` joins them.
    """
    def fetch(df: DataFrame) -> list:
        rows = df.limit(Lexicon.MAX_ENTRIES + 1).collect()
        if len(rows) > Lexicon.MAX_ENTRIES:
            raise ValueError(f"word list exceeds {Lexicon.MAX_ENTRIES} entries")
        return rows

    def exceptions(path: str, pos: str) -> dict[str, str]:
        return {row["form"]: row["lemma"] for row in fetch(lemma_exceptions(spark, path, pos))}

    verbs = frozenset(row["word"] for row in fetch(indexed_words(spark, verb_index))) if verb_index else frozenset()
    return Lexicon(exceptions(verb_exceptions, "v"), exceptions(noun_exceptions, "n"), verbs)
