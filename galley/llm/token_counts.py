"""Token counts by section, from one encoding of the whole document.

The document is encoded once. The tokens' character spans are joined with the character spans of the
sections, and each token is allocated by an explicit rule:

* ``start``: to the section that holds its first character;
* ``most``: to the section that holds most of its characters, the earlier one on a tie.

Both allocate every token exactly once, so the counts of the sections add up to the count of the
document. A token whose characters lie in several sections is also counted as crossing in the section
it is allocated to. A token that holds part of a character spans the whole character.

``lines`` makes the sections: a section ends after each line feed. A null or empty text has one empty
section without tokens. Repeated rows are counted each on its own, other columns are ignored, and an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.llm.common import slices, texts_as_bytes
from galley.llm.pieces import encoder

SCHEMA = "doc_id long, section int, char_start long, char_end long, n_tokens long, n_crossing long"


def lines(data: np.ndarray) -> np.ndarray:
    """Byte offsets at which sections end: behind each line feed, and at the end of the text."""
    ends = np.flatnonzero(data == 10) + 1
    return ends if len(ends) and ends[-1] == len(data) else np.append(ends, len(data))


def allocate(first: np.ndarray, last: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token of characters ``first``..``last`` (inclusive), and whether it crosses."""
    of_first, of_last = np.searchsorted(ends, first, "right"), np.searchsorted(ends, last, "right")
    crossing = of_first != of_last
    if rule == "start" or not crossing.any():
        return of_first, crossing
    chosen = of_first.copy()
    starts = np.concatenate([[0], ends[:-1]])
    for token in np.flatnonzero(crossing).tolist():
        sections = np.arange(of_first[token], of_last[token] + 1)
        held = np.minimum(ends[sections], last[token] + 1) - np.maximum(starts[sections], first[token])
        chosen[token] = sections[np.argmax(held)]
    return chosen, crossing


def section_tokens(docs: DataFrame, tokenizer: str, rule: str = "start", doc_id: str = "doc_id", text: str = "text", sections=lines) -> DataFrame:
    """One row per section: its characters, its tokens, and how many of them cross its borders.

    ``sections`` maps the text's bytes to the ascending byte offsets at which sections end, at
    character borders, the last of them the length of the text.
    """
    if rule not in ("start", "most"):
        raise ValueError(f"unknown rule {rule!r}")

    def run(batches):
        tool = encoder(tokenizer)
        lengths = tool.byte_lengths()
        for batch in slices(batches, "text"):
            texts = texts_as_bytes(batch.column("text"))
            ids, counts = tool.encode(batch.column("text"))
            token_ends, at, rows = lengths[ids], 0, []
            for key, value, count in zip(batch.column("doc_id").to_pylist(), texts, counts.tolist()):
                data = np.frombuffer(value, np.uint8)
                character = np.cumsum((data & 0xC0) != 0x80)  # number of the character of a byte, from 1
                ends = np.concatenate([[0], character])[sections(data)]
                stop = np.cumsum(token_ends[at : at + count])
                at += count
                first = character[stop - token_ends[at - count : at]] - 1
                chosen, crossing = allocate(first, character[stop - 1] - 1, ends, rule)
                size = len(ends)
                rows.append(
                    pa.RecordBatch.from_arrays(
                        [
                            pa.array([key] * size, pa.int64()),
                            pa.array(np.arange(size, dtype=np.int32)),
                            pa.array(np.concatenate([[0], ends[:-1]]).astype(np.int64)),
                            pa.array(ends.astype(np.int64)),
                            pa.array(np.bincount(chosen, minlength=size).astype(np.int64)),
                            pa.array(np.bincount(chosen[crossing], minlength=size).astype(np.int64)),
                        ],
                        ["doc_id", "section", "char_start", "char_end", "n_tokens", "n_crossing"],
                    )
                )
            if rows:
                yield from pa.Table.from_batches(rows).combine_chunks().to_batches()

    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, SCHEMA)
