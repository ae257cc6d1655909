"""Part-of-speech filter and lemmas for English words, inside the row.

Tags come from closed-class tables and suffixes, lemmas from exception tables and detachment rules.
Both depend on the word alone, so each word is tested once and no token leaves its row: no explode,
no join and no regrouping by document.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from galley.functions.text import lookup, one_of, select_words, sql_list
from galley.functions.words import (
    CLOSED_CLASS_WORDS,
    ED_ING_NON_VERBS,
    IRREGULAR_NOUNS,
    IRREGULAR_VERBS,
    LY_NON_ADVERBS,
    OE_PLURALS,
)

ADJECTIVE = r"(?:able|ible|ful|less|ous|ive|ish|ical|ial)$"

# Stems that lost a final e before -ed or -ing: "creat", "announc", "manag", "provid", ...
LOST_E = (
    r"(?:c|u|v|[^z]z|[^s]s"
    r"|[bcdfgkptz]l|[^aeiou]il|ul"
    r"|[dlr]g|[a-z][a-z]ang|eng|[aeiou]g"
    r"|[^aeiou](?:id|ad|od|ud)"
    r"|[^aeo](?:ar|ir|ur)|(?:st|sc|pl|gn)or"
    r"|[^eo]at|[a-z][^aeo]ut|[mvn]ot|[lp]et"
    r"|[^aeiou]in|um|com|cap|[^aeiou][aio]k|ib"
    r")$"
)
# One vowel between consonants, as in "mak" or "hop": a doubled consonant would have survived.
SHORT_STEM = r"^[^aeiou]*[aeiou][^aeiouwxy]$"
# A doubled l is undone in stems of several syllables: "controll", "travell", but not "call".
DOUBLED = r"(?:bb|dd|gg|mm|nn|pp|rr|tt|[aeiou][^aeiou]+[aeiou]ll)$"


@dataclass(frozen=True)
class Lexicon:
    """Driver-side word tables that become literals of the plan.

    English exception lists have a few thousand entries; the bound keeps a wrong file from being
    shipped with every task.
    """

    verb_exceptions: Mapping[str, str] = field(default_factory=lambda: IRREGULAR_VERBS)
    noun_exceptions: Mapping[str, str] = field(default_factory=lambda: IRREGULAR_NOUNS)
    verbs: frozenset[str] = frozenset()

    MAX_ENTRIES = 50_000

    def __post_init__(self) -> None:
        entries = len(self.verb_exceptions) + len(self.noun_exceptions) + len(self.verbs)
        if entries > self.MAX_ENTRIES:
            raise ValueError(f"lexicon of {entries} entries is too large for plan literals")


ENGLISH = Lexicon()


def is_adverb(word: Column) -> Column:
    return word.endswith("ly") & ~one_of(word, LY_NON_ADVERBS)


def is_kept(word: Column) -> Column:
    """Noun, adjective or verb: neither closed class nor adverb."""
    return ~one_of(word, CLOSED_CLASS_WORDS) & ~is_adverb(word)


def regular_verb_form(word: Column) -> Column:
    ending = (word.endswith("ing") & (F.length(word) >= 5)) | (word.endswith("ed") & (F.length(word) >= 4))
    return ending & ~one_of(word, ED_ING_NON_VERBS)


def _plural_ending(word: Column) -> Column:
    other = word.endswith("ss") | word.endswith("us") | word.endswith("is")
    return word.endswith("s") & ~other & (F.length(word) > 3)


def pos_tag(word: Column, lexicon: Lexicon = ENGLISH) -> Column:
    """``X`` closed class, ``RB`` adverb, ``VB`` verb, ``JJ`` adjective, ``NNS`` plural, else ``NN``."""
    return (
        F.when(one_of(word, CLOSED_CLASS_WORDS), "X")
        .when(is_adverb(word), "RB")
        .when(one_of(word, lexicon.verb_exceptions) | regular_verb_form(word), "VB")
        .when(word.rlike(ADJECTIVE), "JJ")
        .when(_plural_ending(word), "NNS")
        .otherwise("NN")
    )


def _restore(stem: Column) -> Column:
    return (
        F.when(stem.rlike(DOUBLED), F.substr(stem, F.lit(1), F.length(stem) - 1))
        .when(stem.rlike(LOST_E) | stem.rlike(SHORT_STEM), F.concat(stem, F.lit("e")))
        .otherwise(stem)
    )


def _cut(word: Column, n: int) -> Column:
    return F.substr(word, F.lit(1), F.length(word) - n)


def rule_verb_lemma(word: Column) -> Column:
    return (
        F.when(word.rlike("[aeiouy].*ing$"), _restore(_cut(word, 3)))
        .when(word.endswith("ied"), F.when(F.length(word) == 4, _cut(word, 1)).otherwise(F.concat(_cut(word, 3), F.lit("y"))))
        .when(word.endswith("eed"), word)
        .when(word.rlike("[aeiouy].*ed$"), _restore(_cut(word, 2)))
        .otherwise(word)
    )


def detached_forms(word: Column) -> Column:
    """The word and its forms without a verb's endings; null where an ending does not fit."""
    def detach(suffix: str, ending: str) -> Column:
        return F.when(word.endswith(suffix), F.concat(_cut(word, len(suffix)), F.lit(ending)))

    # The verb detachment rules of the public Morphy algorithm.
    rules = [("s", ""), ("ies", "y"), ("es", "e"), ("es", ""), ("ed", "e"), ("ed", ""), ("ing", "e"), ("ing", "")]
    return F.array(word, *[detach(*rule) for rule in rules])


def _indexed_verb_lemma(word: Column, verbs: frozenset[str]) -> Column:
    """Shortest detached form that is a known verb; the word itself if there is none."""
    known = F.filter(detached_forms(word), lambda form: one_of(form, verbs))
    shortest = F.array_min(F.transform(known, lambda form: F.struct(F.length(form).alias("n"), form.alias("form"))))
    return F.coalesce(shortest["form"], word)


def verb_lemma(word: Column, lexicon: Lexicon = ENGLISH) -> Column:
    regular = _indexed_verb_lemma(word, lexicon.verbs) if lexicon.verbs else rule_verb_lemma(word)
    return F.coalesce(lookup(word, lexicon.verb_exceptions), regular)


def rule_noun_lemma(word: Column) -> Column:
    return (
        F.when(word.endswith("men") & word.rlike("[a-z]{2}men$"), F.concat(_cut(word, 2), F.lit("an")))
        .when(~_plural_ending(word), word)
        .when(word.endswith("ies"), F.concat(_cut(word, 3), F.lit("y")))
        .when(word.endswith("oes") & ~one_of(word, OE_PLURALS), _cut(word, 2))
        .when(word.endswith("es") & word.rlike("(?:ches|shes|sses|xes|zzes|[^aeo]uses)$"), _cut(word, 2))
        .otherwise(_cut(word, 1))
    )


def noun_lemma(word: Column, lexicon: Lexicon = ENGLISH) -> Column:
    return F.coalesce(lookup(word, lexicon.noun_exceptions), rule_noun_lemma(word))


def _inflected_lemma(word: Column, lexicon: Lexicon) -> Column:
    """Verb lemma for verb forms, noun lemma for all other words.

    Both exception tables are searched at once. Verbs come first there, and a noun that looks like
    a regular verb form is left out, as such words are tagged as verbs.
    Most words are in no table and have no ending that a rule takes off; they are told by one lookup.
    """
    nouns = {
        form: lemma
        for form, lemma in lexicon.noun_exceptions.items()
        if form in ED_ING_NON_VERBS or not form.endswith(("ing", "ed"))
    }
    listed = {**nouns, **lexicon.verb_exceptions}
    regular = _indexed_verb_lemma(word, lexicon.verbs) if lexicon.verbs else rule_verb_lemma(word)
    ruled = F.when(regular_verb_form(word), regular).otherwise(rule_noun_lemma(word))
    inflected = word.endswith("s") | word.endswith("ed") | word.endswith("ing") | word.endswith("men")
    ruled = F.when(inflected, ruled).otherwise(word)
    return F.when(one_of(word, listed), lookup(word, listed)).otherwise(ruled) if listed else ruled


def lemma(word: Column, lexicon: Lexicon = ENGLISH) -> Column:
    """Verb lemma for verbs, noun lemma for nouns and adjectives; other words stay as they are."""
    return F.when(is_kept(word), _inflected_lemma(word, lexicon)).otherwise(word)


def keep_pos(words: Column, dropped: Sequence[str] = ()) -> Column:
    """Words that are nouns, adjectives or verbs, without the words of a further list."""
    return select_words(
        words,
        f"w NOT IN ({sql_list([*CLOSED_CLASS_WORDS, *dropped])})"
        f" AND NOT (endswith(w, 'ly') AND w NOT IN ({sql_list(LY_NON_ADVERBS)}))",
    )


def lemmatize(words: Column, lexicon: Lexicon = ENGLISH) -> Column:
    return F.transform(words, lambda word: lemma(word, lexicon))


def lemmatize_kept(words: Column, dropped: Sequence[str] = (), lexicon: Lexicon = ENGLISH) -> Column:
    """``keep_pos`` and ``lemmatize`` in one pass each, without testing kept words again."""
    return F.transform(keep_pos(words, dropped), lambda word: _inflected_lemma(word, lexicon))
