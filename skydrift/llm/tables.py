"""Intermediate tables in the shared folder, and the size of Arrow batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skydrift.session import scratch_path

#: Batches that go to and from Python have about so many bytes, unless the session
#: sets a size of its own: a worker, and the executor beside it, hold some of them.
BATCH_BYTES = "4m"
_KEY, _DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20)


def small_batches(spark: SparkSession) -> None:
    """Called before each pass over texts is planned."""
    if (spark.conf.get(_KEY, None) or _DEFAULT).lower().rstrip("b") in (_DEFAULT, "64m"):
        spark.conf.set(_KEY, BATCH_BYTES)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df``, written to and read from the shared folder: its lineage is cut,
    its rows are fixed, and it survives lost executors."""
    small_batches(df.sparkSession)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
