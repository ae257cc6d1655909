"""Benchmark decontamination: n-gram windows of test items found in training text.

The windows of the items are hashed, and the sorted hashes travel to every executor in broadcasts of
a bounded size. Each task maps words to numbers, hashes every window of its documents in one pass
over numpy arrays, verifies each hash hit against the window's words, and marks the words covered.

Words are maximal runs of characters other than ASCII control characters, blanks, punctuation; A-Z
are lower-cased first. An item with fewer words than ``n`` is one window, an item without words
matches nothing.

Null and empty texts have no words. Repeated rows are judged each on its own. Items that share an id
count once. An item without id is named ``null``. Other columns of ``docs`` are ignored by ``mark``
and kept by ``remove_spans`` and ``remove_documents``.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.llm.common import ddl, fresh, slices, texts_as_bytes
from galley.llm.memory import tidied
from galley.session import materialize

WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
GAP = re.compile(rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]")
#: Text bytes of items in one broadcast. More items take more passes over the documents.
BROADCAST_BYTES = 64 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SEGMENT = 4 << 20


def _segments(text: bytes) -> Iterator[bytes]:
    """The lower-cased text in pieces cut between words, so that no list of words gets long."""
    at = 0
    while at < len(text):
        gap = GAP.search(text, at + _SEGMENT)
        end = gap.start() if gap else len(text)
        yield text[at:end].lower()
        at = end


class WindowIndex:
    """Windows of the items by length: sorted hashes for the scan, and the words to verify hits."""

    def __init__(self, items: list[tuple[str, bytes]], n: int):
        self.vocabulary: dict[bytes, int] = {}
        self.items: dict[tuple[int, ...], list[str]] = {}
        for name, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for s in _segments(text) for w in WORD.findall(s)]
            size = min(n, len(ids))
            for window in {tuple(ids[i : i + size]) for i in range(len(ids) - size + 1)} if size else ():
                self.items.setdefault(window, []).append(name)
        self.hashes: dict[int, np.ndarray] = {}
        for size in sorted({len(window) for window in self.items}):
            rows = np.array([w for w in self.items if len(w) == size], dtype=np.uint64)
            self.hashes[size] = np.unique(_hash([rows[:, j] for j in range(size)]))

    def word_ids(self, text: bytes) -> np.ndarray:
        """A number for each word, 0 for words of no item."""
        parts = [
            np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.uint64, len(words))
            for words in map(WORD.findall, _segments(text))
        ]
        return np.concatenate(parts) if parts else np.empty(0, np.uint64)

    def find(self, ids: np.ndarray) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, length, item names) of each window of an item in ``ids``."""
        for size, hashes in self.hashes.items():
            if len(ids) < size:
                continue
            known = np.concatenate([[0], np.cumsum(ids == 0)])
            starts = np.flatnonzero(known[size:] == known[:-size])
            found = _hash([ids[starts + j] for j in range(size)])
            at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
            for start in starts[hashes[at] == found].tolist():
                names = self.items.get(tuple(ids[start : start + size].tolist()))
                if names:
                    yield start, size, names


def _hash(columns: list[np.ndarray]) -> np.ndarray:
    value = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        value = (value ^ (value >> np.uint64(29))) * _BASE + column
    return value


def _indexes(benchmark: DataFrame, n: int, item: str, text: str, limit: int) -> Iterator[WindowIndex]:
    """Indexes of at most about ``limit`` text bytes each; which items share one follows a hash."""
    items = benchmark.select(
        F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("name"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-total // limit) or 1
    for part in range(parts):
        mine = items.where(F.pmod(F.xxhash64("name", "text"), F.lit(parts)) == part)
        yield WindowIndex([(row.name, row.text.encode()) for row in mine.collect()], n)


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
    columns: list[str] | None = None,
    cut: bool = False,
) -> DataFrame:
    """Per row: ``columns`` (default: the id), ``n_words``, ``hit_words`` (positions), ``items`` (ids).

    New columns whose names are taken get underscores. With ``cut`` the text, if it is among the
    columns, comes without its runs of hit words.
    """
    columns = columns or [doc_id]
    words, hits, items = (fresh(name, columns) for name in ("n_words", "hit_words", "items"))
    indexes = list(_indexes(benchmark, n, item_id, item_text, broadcast_bytes))
    kept = list(dict.fromkeys([*columns, text]))
    frame = docs.select(*[F.col(f"`{c}`") for c in kept])
    frame = frame.select("*", F.lit(0).cast("long").alias(words), F.array().cast("array<int>").alias(hits), F.array().cast("array<string>").alias(items))
    for number, index in enumerate(indexes):
        last = number == len(indexes) - 1
        out = columns if last else kept
        sent = docs.sparkSession.sparkContext.broadcast(index)
        frame = _scan(frame, sent, text, out, (words, hits, items), cut and last)
        if not last:
            frame = materialize(frame, "decontaminate")
    return frame


def _scan(frame, sent, text, out, names, cut):
    words, hits, items = names
    schema = ddl(frame.select(*[F.col(f"`{c}`") for c in out]), f"`{words}` long", f"`{hits}` array<int>", f"`{items}` array<string>")

    def run(batches):
        index = sent.value
        for batch in slices(batches, text):
            ids = [index.word_ids(value) for value in texts_as_bytes(batch.column(text))]
            counts = [len(x) for x in ids]
            first = np.concatenate([[0], np.cumsum(np.array(counts) + 1)])
            joined = np.concatenate([x for doc in ids for x in (doc, np.zeros(1, np.uint64))])
            covered = [set(x) for x in batch.column(hits).to_pylist()]
            named = [set(x) for x in batch.column(items).to_pylist()]
            for start, size, found in index.find(joined):
                row = int(np.searchsorted(first, start, "right")) - 1
                covered[row].update(range(start - int(first[row]), start - int(first[row]) + size))
                named[row].update(found)
            kept = [batch.column(c) for c in out]
            if cut and text in out and any(covered):
                values = batch.column(text).to_pylist()
                values = [cut_words(v.encode(), hit).decode() if hit else v for v, hit in zip(values, covered)]
                kept[out.index(text)] = pa.array(values, batch.column(text).type)
            yield pa.RecordBatch.from_arrays(
                [
                    *kept,
                    pa.array(counts, pa.int64()),
                    pa.array([sorted(x) for x in covered], pa.list_(pa.int32())),
                    pa.array([sorted(x) for x in named], pa.list_(pa.string())),
                ],
                [*out, *names],
            )

    return frame.mapInArrow(tidied(run), schema)


def cut_words(text: bytes, hits: Collection[int]) -> bytes:
    """``text`` without each run of hit words, from its first to its last byte."""
    marked, kept, at, run = set(hits), [], 0, None
    for position, match in enumerate(WORD.finditer(text.lower())):
        if position in marked:
            run = (run[0] if run else match.start(), match.end())
        elif run:
            kept.append(text[at : run[0]])
            at, run = run[1], None
    if run:
        kept.append(text[at : run[0]])
        at = run[1]
    return b"".join([*kept, text[at:]])


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = 10, **options) -> DataFrame:
    """``docs`` with every run of hit words cut from the text; a null text stays null."""
    names = docs.columns
    return mark(docs, benchmark, n, columns=names, cut=True, **options).select(*[F.col(f"`{c}`") for c in names])


def remove_documents(docs: DataFrame, benchmark: DataFrame, n: int = 10, text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that hold a window of an item."""
    names = docs.columns
    marked = mark(docs, benchmark, n, text=text, columns=names, **options)
    return marked.where(F.size(F.col(f"`{marked.columns[len(names) + 1]}`")) == 0).select(*[F.col(f"`{c}`") for c in names])
