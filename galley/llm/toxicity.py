"""Toxicity by compression distance.

Two zstandard dictionaries are made from labelled texts: one of ordinary text, and one that holds in
addition the strings typical of toxic text. Every window of a text is compressed with both; a window
that the toxic dictionary makes shorter by some bytes holds such words. A logistic regression turns
the lengths won over a text's windows into a probability, and is calibrated on sampled texts that no
dictionary was made from.

A start of a word is typical of toxic text if it is in ``TYPICAL_TIMES`` as many toxic as ordinary texts,
and significantly so. Near copies of sampled texts count once, as a passage copied many times would
otherwise look typical.

At most ``4 * sample_rows`` labelled rows of a class reach the driver (about ``sample_rows`` toxic and
twice as many ordinary ones), of texts of at most ``sampling.LONGEST_SAMPLED`` bytes; every text is scored
whole. Labels come from rows that are not held
out. Null and empty texts have no window and get the score of a text without any sign. Without labelled
texts of both classes every score is 0. Rows that repeat are scored each on its own; a text labelled
twice is toxic if one label says so. Columns that the operator does not need are ignored by ``score``
and kept by ``remove_toxic``.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.llm.common import ddl, fresh, slices, texts_as_bytes
from galley.llm.sampling import LONGEST_SAMPLED, held_out, sampled

WINDOW, STEP = 48, 32
GRAM = 6
PAD = 16
DICTIONARY_BYTES = 8192
TYPICAL_BYTES = 4096
TYPICAL_RATIO, TYPICAL_TIMES = 22, 20
STEM, LONGEST_START, AGREE = 5, 14, 0.6
THRESHOLD = 0.7
#: A word of four bytes or more with the blank before it.
_WORD = re.compile(rb"[\s][^\s!-/:-@\[-`{-~]{4,}")
#: Bytes won by which windows are counted.
WON = (2, 4, 6)
_SPACE = 1 << 22
_SLICE = 1 << 20


def windows(text: bytes) -> list[bytes]:
    """Overlapping windows over the whole text, so that a word cut by one is whole in the next."""
    return [text[i : i + WINDOW] for i in range(0, max(1, len(text) - (WINDOW - STEP)), STEP)] if text else []


def _grams(text: bytes) -> np.ndarray:
    data = np.frombuffer(text, np.uint8).astype(np.uint64)
    size = len(data) - GRAM + 1
    if size <= 0:
        return np.empty(0, np.int64)
    value = np.zeros(size, np.uint64)
    for step in range(GRAM):
        value = (value + data[step : step + size]) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
    return (value % np.uint64(_SPACE)).astype(np.int64)


def _distinct(texts: list[bytes]) -> list[bytes]:
    """Texts without near copies of earlier ones, by the 16 lowest of their hashed grams."""
    owners: dict[int, list[int]] = {}
    kept = []
    for text in texts:
        grams = np.unique(_grams(text))
        lowest = grams[np.argsort(grams * 2654435761 % _SPACE, kind="stable")[:16]].tolist()
        shared = Counter(owner for gram in lowest for owner in owners.get(gram, ()))
        if not shared or max(shared.values()) < 5:
            for gram in lowest:
                owners.setdefault(gram, []).append(len(kept))
            kept.append(text)
    return kept


def _counts(texts: list[bytes]) -> Counter[bytes]:
    """In how many texts each start of a word stands, the blank before it included."""
    counts: Counter[bytes] = Counter()
    for text in texts:
        words = set(_WORD.findall(b" " + text))
        counts.update({w[:n] for w in words for n in range(STEM, min(len(w), LONGEST_START) + 1)})
    return counts


def _filled(words: list[bytes], size: int) -> bytes:
    """The first words that fit, the first of them last: matches near the end cost least."""
    chosen, held = [], 0
    for word in words:
        if held + len(word) <= size:
            chosen.append(word)
            held += len(word)
    return b"".join(reversed(chosen))


def typical_starts(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """The shortest starts of words that are far more frequent in toxic texts, by a likelihood ratio test."""
    counts, others = _counts(toxic), _counts(ordinary)
    a, b = len(toxic), len(ordinary)
    chosen: set[bytes] = set()
    for start in sorted(counts, key=lambda w: (len(w), w)):
        n, m = counts[start], others[start]
        if m * a * TYPICAL_TIMES > n * b or any(start[:size] in chosen for size in range(STEM, len(start))):
            continue
        share = (n + m) / (a + b)
        if 2 * (n * np.log(n / (a * share)) + (m * np.log(m / (b * share)) if m else 0)) > TYPICAL_RATIO:
            chosen.add(start)
    return sorted(chosen, key=lambda w: (-counts[w], w))


def typical_strings(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Typical starts, each as far as most of its words agree."""
    starts = typical_starts(toxic, ordinary)
    counts = _counts(toxic)
    longer: dict[bytes, tuple[int, bytes]] = {}
    for word, n in counts.items():
        longer[word[:-1]] = max(longer.get(word[:-1], (0, b"")), (n, word))
    typical = []
    for start in starts:
        while longer.get(start, (0, b""))[0] >= AGREE * counts[start]:
            start = longer[start][1]
        typical.append(start)
    return list(dict.fromkeys(typical))


@dataclass
class ToxicityModel:
    ordinary: bytes = b""
    toxic: bytes = b""
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        settings = zstandard.ZstdCompressionParameters(
            window_log=15, hash_log=14, chain_log=14, strategy=zstandard.STRATEGY_LAZY, min_match=5, search_log=6,
            write_content_size=0, write_checksum=0, write_dict_id=0,
        )
        return tuple(
            zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(data, zstandard.DICT_TYPE_RAWCONTENT), compression_params=settings)
            for data in (self.ordinary, self.toxic)
        )

    def features(self, texts: list[bytes], tools) -> np.ndarray:
        """Per text: logarithms of the windows that won so many bytes or more, and the share of those of the second bound."""
        found = [windows(t.lower()) for t in texts]
        counts = np.array([len(w) for w in found], np.int64)
        # the same known bytes before each window: else a window without any match is stored, whatever else it holds
        joined = [self.ordinary[-PAD:] + w for part in found for w in part]
        out = np.zeros((len(texts), len(WON) + 1))
        if not joined:
            return out
        lengths = [np.fromiter(map(len, tool.multi_compress_to_buffer(joined, threads=0)), np.int64, len(joined)) for tool in tools]
        won = lengths[0] - lengths[1]
        row = np.repeat(np.arange(len(texts)), counts)
        for column, bound in enumerate(WON):
            out[:, column] = np.log1p(np.bincount(row[won >= bound], minlength=len(texts)))
        out[:, -1] = np.sqrt(np.bincount(row[won >= WON[1]], minlength=len(texts)) / np.maximum(counts, 1))
        return out

    def scores(self, texts: list[bytes], tools) -> np.ndarray:
        if not len(self.weights):
            return np.zeros(len(texts))
        return 1 / (1 + np.exp(-(self.features(texts, tools) @ self.weights[1:] + self.weights[0])))


def _logistic(rows: np.ndarray, labels: np.ndarray, importance: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights (the intercept first) by Newton's method with a ridge penalty."""
    full = np.column_stack([np.ones(len(rows)), rows])
    weights = np.zeros(full.shape[1])
    ridge = penalty * np.eye(len(weights))
    ridge[0, 0] = 1e-6
    for _ in range(50):
        chance = 1 / (1 + np.exp(-full @ weights))
        slope = full.T @ (importance * (chance - labels)) + ridge @ weights
        curve = (full * (importance * chance * (1 - chance))[:, None]).T @ full + ridge
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-9:
            break
    return weights


def train(toxic: list[bytes], ordinary: list[bytes], toxic_share: float = 0.33) -> ToxicityModel:
    """Dictionaries from two of three texts, calibration on the third; ``toxic_share`` is the weight of the toxic ones."""
    toxic, ordinary = (_distinct([t.lower() for t in texts]) for texts in (toxic, ordinary))
    if len(toxic) < 3 or len(ordinary) < 3:
        return ToxicityModel()
    split = lambda texts: ([t for i, t in enumerate(texts) if i % 3], texts[::3])
    (toxic_fit, toxic_kept), (ordinary_fit, ordinary_kept) = split(toxic), split(ordinary)
    samples = [w for t in ordinary_fit for w in windows(t)]
    try:
        base = zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=32, d=8).as_bytes()
    except zstandard.ZstdError:  # too few samples to choose from
        base = b"".join(samples)[-DICTIONARY_BYTES:]
    typical = typical_strings(toxic_fit, ordinary_fit)
    model = ToxicityModel(base, _filled(typical, TYPICAL_BYTES) + base)
    tools = model.compressors()
    labels = np.repeat([1.0, 0.0], [len(toxic_kept), len(ordinary_kept)])
    importance = np.where(labels == 1, toxic_share / len(toxic_kept), (1 - toxic_share) / len(ordinary_kept)) * len(labels)
    model.weights = _logistic(model.features([*toxic_kept, *ordinary_kept], tools), labels, importance)
    return model


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 2500, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> ToxicityModel:
    """Learn from labelled rows that are not held out."""
    known = (
        labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{toxic}`").alias("toxic"))
        .where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out("id"))
        .groupBy("id").agg(F.max("toxic").alias("toxic"))
    )
    frame = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")).where(F.octet_length("text") <= LONGEST_SAMPLED)
    texts: dict[int, list[bytes]] = {}
    for label, size in ((1, sample_rows), (0, 2 * sample_rows)):
        chosen = sampled(known.where(F.col("toxic") == label), size, "id", "toxicity").select("id")
        rows = frame.join(F.broadcast(chosen), "id").limit(2 * size).collect()  # at most 2 * size ids are broadcast
        texts[label] = [r.text.encode() for r in sorted(rows, key=lambda r: (r.id, r.text))]
    return train(texts[1], texts[0])


def score(
    docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, columns: list[str] | None = None
) -> DataFrame:
    """``columns`` (default: the id), ``held_out``, ``score`` and ``predicted``, one row per row of ``docs``."""
    columns = columns or [doc_id]
    names = [fresh(name, columns) for name in ("held_out", "score", "predicted")]
    carried = list(dict.fromkeys([*columns, text]))
    frame = docs.select(*[F.col(f"`{c}`") for c in carried], held_out(doc_id).alias(fresh("held_out", carried)))
    held = frame.columns[-1]
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of a fixed size

    def run(batches):
        model = sent.value
        tools = model.compressors() if len(model.weights) else None
        for batch in slices(batches, text, _SLICE):
            scores = model.scores(texts_as_bytes(batch.column(text)), tools)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), batch.column(held), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                [*columns, *names],
            )

    schema = ddl(frame.select(*[F.col(f"`{c}`") for c in columns]), f"`{names[0]}` boolean", f"`{names[1]}` double", f"`{names[2]}` int")
    return frame.mapInArrow(run, schema)


def remove_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, **options) -> DataFrame:
    """``docs`` without the rows predicted toxic."""
    names = docs.columns
    scored = score(docs, model, threshold=threshold, columns=names, **options)
    return scored.where(F.col(f"`{scored.columns[-1]}`") == 0).select(*[F.col(f"`{c}`") for c in names])
