"""Places of rows within their key, counted over range partitions, so that no key is gathered in one task."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galley.llm.common import ddl, fresh
from galley.session import materialize


def numbered(rows: DataFrame, key: str, order: Sequence[str], bounds: Sequence[Column], place: str, drop: Sequence[str] = ()) -> DataFrame:
    """``rows`` and the place (from 0) of each within its key, by ``order``, nulls first; a null key is a key.

    The rows are sorted over range partitions by ``key`` and ``bounds``, which must not contradict
    ``order`` but may be shorter (a prefix of a text), as the sampled ones go through the driver. A key
    of any size spreads over partitions; each continues the count of those before it, which are one
    small row per partition. ``drop`` names columns of ``order`` that the result does not need.
    """
    by = [F.col(key).asc_nulls_first()]
    ordered = rows.repartitionByRange(*by, *[b.asc_nulls_first() for b in bounds])
    ordered = ordered.sortWithinPartitions(*by, *[F.col(c).asc_nulls_first() for c in order]).drop(*drop)
    part = fresh("part", [*ordered.columns, place])
    counted = materialize(ordered.mapInArrow(_counting(ordered.columns.index(key), place, part), ddl(ordered, f"`{place}` long", f"`{part}` int")), "numbered")
    earlier = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    pieces = counted.groupBy(key, part).agg(F.count("*").alias("n"))
    carried = pieces.select(F.col(key).alias("_key"), F.col(part).alias("_part"), F.sum("n").over(earlier).alias("_before")).where("_before IS NOT NULL")
    # At most one continued key per partition, so this is bounded by the number of partitions.
    same = counted[key].eqNullSafe(F.col("_key")) & (counted[part] == F.col("_part"))
    joined = counted.join(F.broadcast(carried), same, "left")
    kept = [F.col(c) for c in ordered.columns]
    return joined.select(*kept, (F.col(place) + F.coalesce("_before", F.lit(0))).alias(place))


def _counting(key: int, place: str, number: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, count, begun = None, 0, False
        for batch in batches:
            places = np.empty(batch.num_rows, np.int64)
            for row, value in enumerate(batch.column(key).to_pylist()):
                count = count + 1 if begun and value == last else 0
                last, begun = value, True
                places[row] = count
            parts = pa.array(np.full(batch.num_rows, part, np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places), parts], names=[*batch.schema.names, place, number])

    return run
