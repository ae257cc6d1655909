"""Lemmas from word tables of any size: distinct words meet the table in a join, and texts get them back in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galley.functions import lexical
from galley.functions.text import one_of
from galley.functions.words import ED_ING_NON_VERBS
from galley.operators.skew import joined_by_term
from galley.operators.terms import numbered_rows
from galley.session import materialize


def by_form(table: DataFrame) -> DataFrame:
    """``(form, verb, noun)`` from ``(pos, form, lemma)``, pos ``v`` or ``n``; of several lemmas the first in order."""
    lemma = lambda pos: F.min(F.when(F.col("pos") == pos, F.col("lemma")))
    return table.groupBy("form").agg(lemma("v").alias("verb"), lemma("n").alias("noun"))


def word_lemmas(words: DataFrame, table: DataFrame, verbs: DataFrame | None = None) -> DataFrame:
    """``(word, lemma)`` of distinct ``words`` (word), by ``table`` (pos, form, lemma), else by rule.

    The order is that of ``lexical.lemma``: listed verb forms, listed nouns that do not look like a regular
    verb form, regular verb forms, regular plurals; closed-class words and adverbs stay. With ``verbs``
    (word) a regular verb form becomes its shortest detached form that is listed there.
    """
    word = F.col("word")
    rows = words.join(by_form(table).withColumnRenamed("form", "word"), "word", "left")
    regular: Column = lexical.rule_verb_lemma(word)
    if verbs is not None:
        forms = words.select("word", F.explode(lexical.detached_forms(word)).alias("form")).where("form IS NOT NULL")
        known = forms.join(verbs.select(F.col("word").alias("form")).distinct(), "form", "left_semi")
        shortest = F.min(F.struct(F.length("form").alias("n"), F.col("form").alias("form")))
        rows = rows.join(known.groupBy("word").agg(shortest.alias("known")), "word", "left")
        regular = F.coalesce("known.form", word)
    noun = F.when(one_of(word, ED_ING_NON_VERBS) | ~(word.endswith("ing") | word.endswith("ed")), F.col("noun"))
    rule = F.when(lexical.regular_verb_form(word), regular).otherwise(lexical.rule_noun_lemma(word))
    lemma = F.when(lexical.is_kept(word), F.coalesce("verb", noun, rule)).otherwise(word)
    return rows.select("word", lemma.alias("lemma"))


def lemmatize_by_table(df: DataFrame, words: Column, table: DataFrame, output: str = "lemmas", verbs: DataFrame | None = None) -> DataFrame:
    """``df`` with its words' lemmas, joined by one space, in their order; no words give an empty text.

    Each distinct word is looked up once. The lemmas go back to the texts by a join that no frequent word
    can skew, and a text's words are ordered within its own group.
    """
    rows = numbered_rows(df, "texts")
    placed = materialize(rows.select("_row", F.posexplode(words).alias("place", "term")), "placed_words")
    found = materialize(word_lemmas(placed.select(F.col("term").alias("word")).distinct(), table, verbs), "lemmas")
    back = joined_by_term(placed, found.withColumnRenamed("word", "term"))
    pairs = F.array_sort(F.collect_list(F.struct("place", "lemma")))
    texts = back.groupBy("_row").agg(F.array_join(F.transform(pairs, lambda p: p["lemma"]), " ").alias(output))
    return rows.join(texts, "_row", "left").select(*df.columns, F.coalesce(output, F.lit("")).alias(output))
