"""Bounded samples of labelled rows and the split by document id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Longer texts are left out of a training sample, which bounds its bytes; they are all scored.
LONGEST_SAMPLED = 100_000


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row may not be learnt from: crc32 of the id as text leaves 1 modulo 3. No id: false."""
    text = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 3 == 1


def sampled(rows: DataFrame, size: int, key: str, seed: str) -> DataFrame:
    """About ``size`` rows (at most twice as many), chosen by a hash of the key; all if there are fewer."""
    total = rows.count()
    share = F.pmod(F.xxhash64(F.lit(seed), F.col(f"`{key}`")), F.lit(max(total, 1)))
    return rows.where(share < size).limit(2 * size)
