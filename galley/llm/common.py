"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from galley.session import ship

#: Text bytes that a task turns into Python objects at a time. It bounds memory, not the work.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores added until no column of ``taken`` has it (case-insensitively)."""
    names = {column.lower() for column in taken}
    while name.lower() in names:
        name += "_"
    return name


def texts_as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null becomes empty."""
    return [value or b"" for value in pc.cast(column, pa.binary()).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each piece holds about ``limit`` text bytes, or one row if that is longer."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_pylist()
        first = held = 0
        for row, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(first, row - first)
                first, held = row, 0
            held += size
        if first < len(sizes):
            yield batch.slice(first)


def ddl(df: DataFrame, *more: str) -> str:
    """Schema text of ``df``'s columns followed by ``more``."""
    own = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields]
    return ", ".join([*own, *more])
