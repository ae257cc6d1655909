"""Quality of documents by weak supervision: rules vote or abstain, and their accuracies are estimated.

No label is used. Expectation-maximisation over the counts of vote patterns of all documents gives the
share of good documents and each rule's accuracy among good and among bad ones; a document's score is
the posterior probability of being good, given the votes it got. Abstentions say nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galley.llm.common import SLICE_BYTES, ddl, fresh, slices, texts_as_bytes
from galley.llm.memory import tidied

#: Words of a window, and the characters counted as symbols.
WINDOW, SYMBOLS = 5, b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended_lines", "n_shouted", "n_decorated", "n_lone_marks")
#: Words in capitals, words with marks hung on, and marks that stand alone.
SHOUTED, DECORATED, LONE_MARK = "^[^a-z]*[A-Z][^a-z]*[A-Z][^a-z]*$", "[!#$%&*<=>?@^|~]{2,}$", "^[!-/:-@\\[-`{-~]$"
_KINDS = [re.compile(p.encode()) for p in (SHOUTED, DECORATED, LONE_MARK)]
_BREAK = re.compile(rb"[ \t-\r]")


@dataclass(frozen=True)
class Rule:
    """A vote on the counts: against a document where ``bad`` holds, else for it where ``good`` does."""

    name: str
    bad: str
    good: str

    @property
    def vote(self) -> str:
        return f"CASE WHEN {self.bad} THEN -1 WHEN {self.good} THEN 1 ELSE 0 END"


RULES = (
    Rule("length", "n_words < 5", "n_words >= 50"),
    Rule("word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words)", "word_chars BETWEEN 3 * n_words AND 10 * n_words AND n_words > 0"),
    Rule("symbols", "10 * n_symbols > n_words", "n_words > 0 AND 100 * n_symbols <= n_words"),
    Rule("line_copies", "n_dup_lines >= 2 AND 10 * n_dup_lines > 3 * n_lines", "n_lines >= 3 AND n_dup_lines = 0"),
    Rule("repeats", "10 * n_repeat_words > n_words", "n_words >= 20 AND 100 * n_repeat_words <= n_words"),
    Rule("line_ends", "n_words >= 20 AND n_ended_lines = 0", "n_lines > 0 AND 2 * n_ended_lines >= n_lines"),
    Rule("capitals", "10 * n_shouted > 3 * n_words", "n_words >= 20 AND 20 * n_shouted <= n_words"),
    Rule("decoration", "10 * n_decorated > n_words", "n_words >= 20 AND 50 * n_decorated <= n_words"),
    Rule("lone_marks", "10 * n_lone_marks > n_words", "n_words >= 20 AND 50 * n_lone_marks <= n_words"),
)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with its ``text`` replaced by ``COUNTS``, counted over whole texts; a null text is empty.

    Words are runs without ASCII white space. ``word_chars``: their code points; ``n_symbols``: characters of
    ``SYMBOLS``; ``n_lines``: lines (between line feeds) with a word; ``n_dup_lines``: those equal to an
    earlier line; ``n_repeat_words``: words in a window of five that stands twice or more in the text;
    ``n_ended_lines``: lines whose last character but white space is ``.``, ``!`` or ``?``; ``n_shouted``:
    words with two ASCII capitals and no small ASCII letter; ``n_decorated``: words with two or more hung-on
    marks; ``n_lone_marks``: words of one ASCII mark. Every row is counted, repeated ones too; a name that
    ``docs`` has gets underscores. An empty table gives an empty one.
    """
    names = [n for n in docs.columns if n != text]
    kept = [F.col(f"`{n}`") for n in names]
    rows = docs.select(*kept, F.col(f"`{text}`").cast("string").alias(fresh("text", names)))
    added = [fresh(c, names) for c in COUNTS]
    return rows.mapInArrow(tidied(_measuring(rows.columns[-1], added)), ddl(docs.select(*kept), *[f"`{c}` long" for c in added]))


def _measuring(text: str, added: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, text):
            counted = counts(texts_as_bytes(piece.column(piece.num_columns - 1)))
            names = [*piece.schema.names[:-1], *added]
            yield pa.RecordBatch.from_arrays([*piece.columns[:-1], *map(pa.array, counted)], names=names)

    return run


def counts(texts: Sequence[bytes]) -> np.ndarray:
    """``COUNTS`` of each text, one row of the result per count."""
    out = np.zeros((len(COUNTS), len(texts)), np.int64)
    codes: dict[bytes, int] = {}
    coded, sizes = [np.zeros(0, np.int64)], np.zeros(len(texts), np.int64)
    for i, data in enumerate(texts):
        for words in _words(data):
            coded.append(np.array([codes.setdefault(w, len(codes)) for w in words], np.int64))
            sizes[i] += len(words)
        lines = [line for line in data.split(b"\n") if line and not line.isspace()]
        out[2, i] = len(data) - len(data.translate(None, SYMBOLS))
        out[3, i] = len(lines) - len(set(lines))
        out[5, i] = len(lines)
        out[6, i] = sum(line.rstrip()[-1:] in b".!?" for line in lines)
    code, owner = np.concatenate(coded), np.repeat(np.arange(len(texts)), sizes)
    traits = np.zeros((4, len(codes)), np.int64)
    for k, word in enumerate(codes):
        traits[:, k] = len(word.decode()), *(bool(p.search(word)) for p in _KINDS)
    totals = [np.bincount(owner, t[code], len(texts)) for t in traits]
    out[[1, 7, 8, 9]] = np.array(totals, np.int64).reshape(4, len(texts))
    out[0] = sizes
    out[4] = np.bincount(owner, _repeated(code, owner), len(texts))
    return out


def _words(data: bytes) -> Iterator[list[bytes]]:
    """The words in pieces, so that a long text is never held as a list of words."""
    start = 0
    while start < len(data):
        found = _BREAK.search(data, start + SLICE_BYTES)
        end = found.start() if found else len(data)
        yield data[start:end].split()
        start = end


def _ranked(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Equal numbers for equal pairs; both hold non-negative numbers below 2^31."""
    return np.unique(high << 31 | low, return_inverse=True)[1]


def _repeated(code: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Whether each word lies in a window that its text holds twice or more."""
    n = len(code) - WINDOW + 1
    covered = np.zeros(len(code) + 1, np.int64)
    if n > 0:
        two = _ranked(code[:-1], code[1:])
        five = _ranked(_ranked(two[:-2], two[2:])[:n], code[4:])
        start = np.flatnonzero(owner[:n] == owner[WINDOW - 1 :])
        _, place, times = np.unique(owner[start] << 31 | five[start], return_inverse=True, return_counts=True)
        hit = start[times[place] > 1]
        np.add.at(covered, hit, 1)
        np.add.at(covered, hit + WINDOW, -1)
    return np.cumsum(covered[:-1]) > 0


#: Rounds of estimation; share of good documents, and of right votes among good and among bad ones, at the start.
ROUNDS, SHARE, RIGHT_GOOD, RIGHT_BAD = 60, 0.9, 0.98, 0.4
#: Rows that stand for the start, and bounds of accuracies. A rule sees one kind of fault, so it may miss most bad documents.
STRENGTH, LEAST, MOST = 10, 0.02, 0.999


@dataclass(frozen=True)
class Model:
    rules: tuple[Rule, ...]
    prior: float
    among_good: tuple[float, ...]
    among_bad: tuple[float, ...]

    def posterior(self) -> Column:
        """Probability of being good, over columns of ``COUNTS``."""
        odds = F.lit(float(np.log(self.prior / (1 - self.prior))))
        for rule, good, bad in zip(self.rules, self.among_good, self.among_bad):
            vote = F.expr(rule.vote)
            odds += F.when(vote == 1, float(np.log(good / (1 - bad)))).when(vote == -1, float(np.log((1 - good) / bad))).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def estimate(counted: DataFrame, rules: Sequence[Rule] = RULES) -> Model:
    """Fit the rules' accuracies on the votes of all rows.

    One grouping counts the vote patterns; at most three to the number of rules of them reach the driver,
    whatever the number of documents. Without rows the accuracies stay at their start.
    """
    rules = tuple(rules)
    votes = counted.select(*[F.expr(r.vote).alias(f"v{j}") for j, r in enumerate(rules)])
    patterns = votes.groupBy(*votes.columns).agg(F.count("*").alias("n")).collect()
    vote = np.array([row[:-1] for row in patterns], np.int64).reshape(-1, len(rules))
    n = np.array([row.n for row in patterns], float)
    return Model(rules, *expectation_maximisation(vote, n))


def expectation_maximisation(vote: np.ndarray, n: np.ndarray) -> tuple[float, tuple[float, ...], tuple[float, ...]]:
    """Share of good rows and accuracies among good and bad ones, from vote patterns and how often they occur.

    A vote against a document is held to be at least as likely for a bad one as for a good one.
    """
    prior, good, bad = SHARE, np.full(vote.shape[1], RIGHT_GOOD), np.full(vote.shape[1], RIGHT_BAD)

    def share(right: np.ndarray, cast: np.ndarray, start: float) -> np.ndarray:
        return np.clip((right + start * STRENGTH) / (cast + STRENGTH), LEAST, MOST)

    for _ in range(ROUNDS):
        odds = np.log(prior / (1 - prior)) + (vote == 1) @ np.log(good / (1 - bad)) + (vote == -1) @ np.log((1 - good) / bad)
        is_good = 1 / (1 + np.exp(-odds))
        of_good, of_bad = n * is_good, n * (1 - is_good)
        prior = (of_good.sum() + SHARE * STRENGTH) / (n.sum() + STRENGTH)
        good = share(of_good @ (vote == 1), of_good @ (vote != 0), RIGHT_GOOD)
        bad = np.maximum(share(of_bad @ (vote == -1), of_bad @ (vote != 0), RIGHT_BAD), 1 - good)
    return float(prior), tuple(map(float, good)), tuple(map(float, bad))


def judged(counted: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``counted`` with ``quality``, the posterior (six decimals), and ``is_good``, whether it reaches the threshold."""
    quality = F.round(model.posterior(), 6)
    return counted.select("*", quality.alias("quality"), (quality >= threshold).alias("is_good"))


def keep_good(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that are good, with all their columns; texts are read once."""
    copy = fresh("copy", docs.columns)
    flat = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(copy), F.col(f"`{text}`").alias("text"))
    return judged(measured(flat), model, threshold).where("is_good").select(f"{copy}.*")
