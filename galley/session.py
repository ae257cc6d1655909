"""Session settings, shared scratch space and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_FALLBACK_KEY = "galley.scratch.dir"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, which need not have it on their path.

    The archive is made in the driver's own folder; executors fetch it from the driver.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent).as_posix())
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder the cluster shares for checkpoints.

    ``spark.checkpoint.dir`` names that folder. Only a local-mode session may go without it; it
    then gets one temporary folder for its lifetime.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_FALLBACK_KEY, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="galley-")
        spark.conf.set(_FALLBACK_KEY, base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where several jobs read one expensive result. Unlike executor caches the copy survives
    lost executors, and the lineage behind it is cut.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def evaluate_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns that later filters must not compute again.

    Catalyst pushes a filter below the projection that defines its column, which copies the
    defining expression into the filter. It does not push filters on generated columns.
    """
    values = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(values)))
