"""Token ids in ORC files.

Documents are range-partitioned by id, encoded whole, ended with an end id and written in ascending
order. ORC stores the ids as integer runs in stripes, with a row index every ``row_index_stride``
documents and a Bloom filter on the ids of documents, so that readers take stripes in parallel and
skip those without the documents they ask for. Each row holds the number of ids before it in its file
part; adding the totals of the earlier parts, one row a part, gives the place in the whole sequence.

Null texts are empty and give the end id alone. Rows without id come first. Repeated rows are all
written, equal ids in order of their text. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from galley.llm.common import slices
from galley.llm.memory import tidied
from galley.llm.pieces import encoder

SCHEMA = "part int, doc_id long, before long, n_tokens long, ids array<int>"


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    stripe_bytes: int = 64 << 20,
    row_index_stride: int = 1000,
) -> None:
    """Encode ``docs`` with the tokenizer file and write the ORC files below ``path``."""
    ordered = (
        docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )

    def run(batches):
        encode, part, before = encoder(tokenizer).encode, TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text"):
            ids, counts = encode(batch.column("text"))
            ids = np.insert(ids, np.cumsum(counts), end_id)
            ends = np.cumsum(counts + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ends), part, np.int32)),
                    batch.column("doc_id"),
                    pa.array(before + ends - counts - 1),
                    pa.array(counts + 1),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids, pa.int32())),
                ],
                ["part", "doc_id", "before", "n_tokens", "ids"],
            )
            before += int(ends[-1])

    (
        ordered.mapInArrow(tidied(run), SCHEMA)
        .write.option("orc.stripe.size", stripe_bytes)
        .option("orc.row.index.stride", row_index_stride)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.compress", "ZSTD")
        .orc(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``(doc_id, start, n_tokens, ids)``; a filter on ``doc_id`` reaches the files' indexes."""
    rows = spark.read.schema(SCHEMA).orc(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    # one row a file part, whatever the number of documents
    return rows.join(F.broadcast(base), "part").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids")


def checksums(tokens: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of rows read from token files."""

    def run(batches):
        for batch in batches:
            ids = batch.column("ids")
            offsets = ids.offsets.to_numpy()
            values = ids.values.to_numpy().astype("<u4", copy=False).view(np.uint8)
            sums = [zlib.crc32(values[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(sums, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(tidied(run), "doc_id long, start long, n_tokens long, ids_crc32 long")
