"""Tables written batch by batch, each batch visible by its last write."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append_batch(tables: Mapping[str, DataFrame], path: str, batch: str, partition_by: Sequence[str] = ()) -> bool:
    """Write the ``tables`` below ``path`` as one batch; false if a batch of that name is in force already.

    Data goes to folders of the batch's own and replaces what a lost attempt left there. The marker is
    written last, so readers see all tables of a batch or none. Batches of different names never touch
    each other's files.
    """
    spark = next(iter(tables.values())).sparkSession
    if batch in committed(spark, path):
        return False
    for name, df in tables.items():
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/{name}/batch={batch}")
    spark.range(1).select("id").write.mode("overwrite").parquet(f"{path}/commits/batch={batch}")
    return True


def committed(spark: SparkSession, path: str) -> set[str]:
    """Names of the batches in force, from the markers' folders: one small row each."""
    try:
        markers = spark.read.schema("id bigint, batch string").parquet(f"{path}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()
    return {row.batch for row in markers.select("batch").distinct().collect()}


def read_batches(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """Rows of a table's batches in force, with their ``batch``; the folders of others are not read.

    ``schema`` names the columns, those of the folders included. Without a batch the table is empty.
    """
    names = sorted(committed(spark, path))
    full = f"{schema}, batch string"
    if not names:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(f"{path}/{name}").where(F.col("batch").isin(names))
