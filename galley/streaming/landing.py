"""Drain a broker topic into a collection, and score articles as they arrive."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from galley import schemas
from galley.functions.records import decode_records
from galley.operators import history as hist
from galley.plans.model import Model
from galley.plans.scoring import classify_requests, extract_requests
from galley.session import materialize


def decoded(records: DataFrame, schema: StructType = schemas.ARTICLE) -> DataFrame:
    """Valid records as rows."""
    return decode_records(records, schema=schema).filter("is_valid").select("record.*")


def rejected(records: DataFrame, schema: StructType = schemas.ARTICLE) -> DataFrame:
    return decode_records(records, schema=schema).filter("NOT is_valid").select("topic", "value")


def land_stream(
    rows: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", trigger: dict | None = None
) -> StreamingQuery:
    """Append a stream to a collection exactly once; offsets live in the checkpoint."""
    writer = rows.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(**(trigger or {"availableNow": True})).start()


def score_stream(
    pages: DataFrame,
    model: Model,
    history_path: str,
    checkpoint: str,
    predicted_at: datetime | None = None,
    trigger: dict | None = None,
    answers_path: str | None = None,
    **options,
) -> StreamingQuery:
    """Extract, normalize and score pages as they arrive; add the new URLs to the history.

    Extraction is part of the stream; each micro-batch is scored on its own, written once, and appended.
    The append looks up the buckets of its URLs only, and skips known ones, which makes a repeated batch
    harmless. With ``answers_path`` every request's answer is kept there as well, one replaceable folder
    per micro-batch.
    """
    def add_batch(batch: DataFrame, batch_id: int) -> None:
        answers = materialize(classify_requests(batch, model, predicted_at, **options), "answers")
        hist.append_history(answers, history_path)
        if answers_path:
            answers.write.mode("overwrite").parquet(f"{answers_path}/batch={batch_id}")

    writer = extract_requests(pages).writeStream.foreachBatch(add_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
