"""Language score from stop-word hits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cache

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

from galley.functions.text import let, lookup, select_words
from galley.functions.words import BUILT_IN_LANGUAGES, ENGLISH_STOP_WORDS

TOKEN_GAP = r"[^\p{L}']+"


@cache
def _stop_words(code: str) -> tuple[str, ...]:
    words = ENGLISH_STOP_WORDS if code == "en" else StopWordsRemover.loadDefaultStopWords(BUILT_IN_LANGUAGES[code])
    return tuple(sorted({word.strip() for word in words}))


def built_in_stop_words(languages: Sequence[str] | None = None) -> dict[str, Sequence[str]]:
    """Stop words by ISO code: the English table of this package and the lists shipped with Spark.

    Needs a running session, as Spark reads its lists from its own jar.
    """
    return {code: _stop_words(code) for code in sorted(languages or ["en", *BUILT_IN_LANGUAGES])}


def language_score(text: Column, word_lists: Mapping[str, Sequence[str]]) -> Column:
    """Struct ``(lang, score)`` of the best language.

    With ``h`` hits per language the score is ``2^h / sum(2^h)`` over all candidates. Ties go to
    the alphabetically first language. Without any hit the language is null and the score 0.
    Each token is looked up once, for the set of its languages as a bit mask. All of it happens
    within the row, so there is no shuffle and streams work as well.
    """
    codes = sorted(word_lists)
    masks: dict[str, int] = {}
    for bit, code in enumerate(codes):
        for word in word_lists[code]:
            masks[word] = masks.get(word, 0) | 1 << bit
    tokens = F.split(F.lower(text), TOKEN_GAP)
    found_masks = F.array_compact(F.transform(tokens, lambda token: lookup(token, masks, "bigint")))

    def hits(found: Column) -> Column:
        return F.array(*[F.size(select_words(found, f"w & {1 << bit}L <> 0")) for bit in range(len(codes))])

    def best(counts: Column) -> Column:
        top = F.array_max(counts)
        mass = F.aggregate(counts, F.lit(0.0), lambda total, n: total + F.pow(F.lit(2.0), n - top))
        lang = F.element_at(F.array(*[F.lit(code) for code in codes]), F.array_position(counts, top).cast("int"))
        return F.struct(
            F.when(top > 0, lang).alias("lang"),
            F.when(top > 0, 1 / mass).otherwise(F.lit(0.0)).alias("score"),
        )

    return let(let(found_masks, hits), best)


def detect_lang(text: Column, word_lists: Mapping[str, Sequence[str]], min_score: float = 0.9) -> Column:
    """Code of the best language, ``NA`` below ``min_score`` or without any hit."""
    return let(
        language_score(text, word_lists),
        lambda best: F.when(best["score"] >= min_score, F.coalesce(best["lang"], F.lit("NA"))).otherwise("NA"),
    )
