"""Text cleaning as column expressions.

Character classes are spelled out instead of using ``\\w``, ``\\d`` and ``\\s``: those are ASCII-only
in Java while the cleaning rules are defined over Unicode letters, digits and white space.
Repetitions run over single classes, never over groups, so no input can exhaust the regex stack.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterable, Mapping
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from galley.functions.words import ENGLISH_STOP_WORDS

# Unicode white space, word characters and the 32 ASCII punctuation marks.
SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"\p{L}\p{N}_"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
DIGITS = "0123456789"

# What counts as a link, a mention and a word to keep.
URL = (
    rf"https?://(?:www[^\n])?[{WORD}]+\.[{WORD}]+"
    rf"[/{WORD}]*?(?=//|[^/{WORD}]|\z)/?"
)
MENTION = rf"@[{WORD}]+"
GAP = rf"[{SPACE}\p{{Nd}}]"
# Between words: marks as well. Single characters of a class are one table to Java, so common ones come as such.
BETWEEN = rf"\x20\n\r\t{''.join(f'\\{mark}' for mark in PUNCTUATION)}0123456789{SPACE}\p{{Nd}}"
# A letter first, as most positions fail there; what was matched holds letters alone, so nothing shorter can fit.
KEPT_TOKEN = rf"[a-z](?<![^{BETWEEN}].)[a-z]{{2,}}+(?![^{BETWEEN}])"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def is_blank(text: Column, compat: bool = False) -> Column:
    """All white space. The empty string counts as blank only by default, not with ``compat``."""
    return text.rlike(rf"\A[{SPACE}]{'+' if compat else '*'}\z")


def strip_non_ascii(text: Column) -> Column:
    """Keep code points 1 to 126."""
    return F.regexp_replace(text, r"[^\x01-\x7e]", "")


def remove_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL, " ")


def remove_mentions(text: Column) -> Column:
    return F.regexp_replace(text, MENTION, " ")


def remove_punctuation(text: Column) -> Column:
    return F.translate(text, PUNCTUATION, " " * len(PUNCTUATION))


def remove_number_words(text: Column) -> Column:
    return F.regexp_replace(text, r"\p{Nd}+", " ")


def remove_digits(text: Column) -> Column:
    """Digits vanish without leaving a space (used on titles)."""
    return F.regexp_replace(text, "[0-9]+", "")


def split_words(text: Column) -> Column:
    """Words between runs of white space, without empty ones."""
    return F.filter(F.split(text, rf"[{SPACE}]+"), lambda word: word != "")


def _without_marks(text: Column) -> Column:
    # Digits turn into single spaces here. Splitting on runs makes that equal to one space per run.
    marks = PUNCTUATION + DIGITS
    return F.translate(remove_mentions(remove_urls(F.lower(text))), marks, " " * len(marks))


def feature_words(text: Column) -> Column:
    """Lower-case words of three or more ASCII letters, after URLs, mentions and marks are gone."""
    return F.regexp_extract_all(remove_mentions(remove_urls(F.lower(text))), F.lit(KEPT_TOKEN), 0)


def remove_features(text: Column, compat: bool = False) -> Column:
    """The feature words as one string.

    With ``compat`` each rejected word leaves one extra space, and a rejected first word one more.
    """
    if not compat:
        return F.array_join(feature_words(text), " ")
    words = F.filter(F.split(_without_marks(text), f"{GAP}+"), lambda word: word != "")
    marked = F.transform(words, lambda word: F.when(word.rlike(r"\A[a-z]{3,}\z"), word).otherwise(""))

    def joined(words: Column) -> Column:
        extra = F.when(F.try_element_at(words, F.lit(1)) == "", " ").otherwise("")
        return F.concat(extra, F.array_join(words, " "))

    return let(marked, joined)


def sql_list(words: Iterable[str]) -> str:
    """The words as a SQL list. One parsed text is far cheaper to build than a literal per word."""
    return ", ".join("'" + word.replace("\\", "\\\\").replace("'", "\\'") + "'" for word in words)


def select_words(words: Column, condition: str) -> Column:
    """Words that meet a SQL condition on ``w``; long IN lists become hash sets."""
    return F.call_function("filter", words, F.expr(f"w -> {condition}"))


def one_of(word: Column, words: Iterable[str]) -> Column:
    return F.call_function("exists", F.array(word), F.expr(f"w -> w IN ({sql_list(words)})"))


def lookup(word: Column, table: Mapping[str, object], value_type: str = "string") -> Column:
    """Value of ``word`` in a constant table, null if absent.

    The table is spread over small maps by CRC-32, as a lookup scans its map from the start. It
    enters the plan as one JSON literal, which the optimizer folds into a constant array of maps.
    """
    buckets: list[dict] = [{} for _ in range(max(1, len(table) // 4))]
    for key, value in table.items():
        buckets[zlib.crc32(key.encode()) % len(buckets)][key] = value
    maps = F.from_json(F.lit(json.dumps(buckets)), f"array<map<string,{value_type}>>")
    number = F.crc32(word.cast("binary")) % len(buckets) + 1
    return F.element_at(F.element_at(maps, number.cast("int")), word)


def drop_words(words: Column, dropped: Iterable[str]) -> Column:
    return select_words(words, f"w NOT IN ({sql_list(dropped)})")


def remove_stop_words(text: Column, stop_words: Iterable[str] = ENGLISH_STOP_WORDS) -> Column:
    """Case-sensitive stop-word removal over white-space separated words."""
    return F.array_join(drop_words(split_words(text), stop_words), " ")


def non_word_split(text: Column) -> Column:
    """Lower-case tokens between non-word characters."""
    return F.filter(F.split(F.lower(text), "[^A-Za-z0-9_]"), lambda token: token != "")


def _code_point(reference: Column) -> Column:
    """Character of a numeric reference without its ``&#`` and ``;``."""
    is_hex = F.lower(F.substring(reference, 1, 1)) == "x"
    digits = F.ltrim(F.ltrim(F.upper(reference), F.lit("X")), F.lit("0"))
    code = F.when(F.length(digits).between(1, 7), F.when(is_hex, F.conv(digits, 16, 10)).otherwise(digits).cast("bigint"))
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    utf_32 = F.lpad(F.hex(F.when(valid, code).otherwise(0xFFFD)), 8, "0")
    # An ampersand stays escaped until the named entities are replaced.
    return F.when(code == 38, "&amp;").otherwise(F.decode(F.unhex(utf_32), "UTF-32"))


def _numeric_unescaped(text: Column) -> Column:
    pattern = F.lit("&#([0-9]+|[xX][0-9a-fA-F]+);")
    references = F.array_distinct(F.regexp_extract_all(text, pattern))

    def put_in(so_far: Column, reference: Column) -> Column:
        return F.replace(so_far, F.concat(F.lit("&#"), reference, F.lit(";")), _code_point(reference))

    return F.when(text.contains("&#"), F.aggregate(references, text, put_in)).otherwise(text)


# Every named character reference of the standard, by its name.
NAMED_CHARACTERS = {name[:-1]: character for name, character in html5.items() if name.endswith(";")}


def _named_unescaped(text: Column) -> Column:
    names = F.array_distinct(F.regexp_extract_all(text, F.lit("&([a-zA-Z][a-zA-Z0-9]*);")))
    # The ampersand comes last: replacing it first would turn "&amp;lt;" into "<".
    ordered = F.concat(select_words(names, "lower(w) <> 'amp'"), select_words(names, "lower(w) = 'amp'"))

    def put_in(so_far: Column, name: Column) -> Column:
        entity = F.concat(F.lit("&"), name, F.lit(";"))
        return F.replace(so_far, entity, F.coalesce(lookup(name, NAMED_CHARACTERS), entity))

    return F.when(text.contains("&"), F.aggregate(ordered, text, put_in)).otherwise(text)


def unescape_html(text: Column) -> Column:
    """Numeric references, then the named entities."""
    return let(let(text, _numeric_unescaped), _named_unescaped)


# Comments, scripts and styles that are never closed hide the rest of the page.
INVISIBLE = (
    r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|<nav\b.*?</nav\s*>"
)
# A tag starts with a letter behind its sign; a bare sign is text.
TAG = r"</?[A-Za-z][^>]*>|<[!?][^>]*>"


def _element(html: Column, tag: str) -> Column:
    """What stands in the first element of a tag, elements of the same tag inside it included."""
    pattern = rf"(?i)</?{tag}\b[^>]*>"
    pieces = F.slice(F.split(html, pattern), 2, F.length(html) + 1)
    parts = F.arrays_zip(F.regexp_extract_all(html, F.lit(pattern), 0).alias("tag"), pieces.alias("piece"))
    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("over"), F.array().cast("array<string>").alias("inside"))

    def step(state: Column, part: Column) -> Column:
        deeper = F.when(part["tag"].startswith("</"), -1).otherwise(1)
        depth = F.when(state["over"], 0).otherwise(F.greatest(state["depth"] + deeper, F.lit(0)))
        taken = F.when(depth > 0, F.concat(state["inside"], F.array(part["piece"]))).otherwise(state["inside"])
        over = state["over"] | ((state["depth"] > 0) & (depth == 0))
        return F.struct(depth.alias("depth"), over.alias("over"), taken.alias("inside"))

    return F.aggregate(parts, start, step, lambda state: F.array_join(state["inside"], " "))


def extract_article_text(html: Column) -> Column:
    """Visible text of the first ``<article>``, else of ``<main>``, else of ``<body>``; empty without any."""

    def body(page: Column) -> Column:
        found = F.lit("")
        for tag in ("body", "main", "article"):
            found = F.when(page.rlike(rf"(?i)<{tag}\b"), _element(page, tag)).otherwise(found)
        return found

    inside = let(F.regexp_replace(html, INVISIBLE, " "), body)
    visible = unescape_html(F.regexp_replace(inside, TAG, " "))
    return F.array_join(split_words(visible), " ")


def extract_table_text(html: Column) -> Column:
    """The cell after the cell ``Text`` in the first table of class ``table``; empty if missing."""
    table = F.regexp_extract(
        html,
        r"""(?is)<table\b[^>]*\bclass\s*=\s*["'](?:[^"']*\s)?table(?:\s[^"']*)?["'][^>]*>(.*?)</table\s*>""",
        1,
    )
    cells = F.regexp_replace(table, r"(?i)<(?!/?(?:td|tr)\b)[^>]*>", "")
    cell = F.regexp_extract(cells, r"<(?i:td)\b[^>]*>Text</(?i:td)\s*>\s*<(?i:td)\b[^>]*>([^<]*)", 1)
    return unescape_html(cell)
