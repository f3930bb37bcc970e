"""Table lifecycle (OP-04, 05, 07-11, 32) and champion decisions (OP-94..96).

Tables are parquet folders (or catalog tables); writes are columnar and
whole-frame, never per-row inserts. Paths come from the caller or from the
session's shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Spark's error conditions for a folder that is missing or holds no files
_MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def table_exists(spark: SparkSession, path: str) -> bool:
    """The folder holds a table (maybe without rows). Any error but a missing
    folder (no permission, a broken file, the network) is raised."""
    try:
        spark.read.parquet(path)
    except AnalysisException as e:
        if (e.getCondition() or "").startswith(_MISSING):
            return False
        raise
    return True


def table_has_rows(spark: SparkSession, path: str) -> bool:
    """Load guard: the table exists and holds at least one row."""
    return table_exists(spark, path) and bool(spark.read.parquet(path).limit(1).take(1))


def write_counted(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                  sort_within: Sequence[str] = ()) -> int:
    """OP-05/07: one write of a whole table; the row count is read from the
    written parquet footers (row-group metadata only, no pass over the data)."""
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return int(df.sparkSession.read.parquet(path).count())


def load_once(spark: SparkSession, path: str, build: Callable[[], DataFrame],
              partition_by: Sequence[str] = ()) -> tuple[DataFrame, int | None]:
    """OP-04: build and write the table only if it is missing or empty;
    returns the table and the written row count (None when it existed)."""
    if table_has_rows(spark, path):
        return spark.read.parquet(path), None
    n = write_counted(build(), path, partition_by)
    return spark.read.parquet(path), n


def materialise_sorted(df: DataFrame, path: str, partition_by: Sequence[str],
                       sort_by: Sequence[str]) -> int:
    """OP-07 + OP-32: CTAS laid out by partition columns and sorted within files
    (min/max statistics then prune date filters). Rows are ranged by partition
    and sort columns together, so a large partition is divided among many
    writers, each with a range of its own, and small ones share a task."""
    laid = df.repartitionByRange(*partition_by, *sort_by)
    return write_counted(laid, path, partition_by, [*partition_by, *sort_by])


BATCH = "batch_id"


def clone_empty(src: DataFrame, path: str) -> bool:
    """OP-08: ``CREATE TABLE IF NOT EXISTS ... (LIKE src)``: same schema, no
    rows. Tables that grow by batches keep each batch in its own folder, and the
    empty clone is batch -1. Returns whether it was made."""
    if table_exists(src.sparkSession, path):
        return False
    src.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{path}/{BATCH}=-1")
    return True


def append_batch(df: DataFrame, path: str, batch_id: int) -> int:
    """OP-09/10: columnar append of one batch, and its row count. A batch that
    is appended again (a retry) replaces itself, and no other batch's rows are
    listed or counted."""
    return write_counted(df, f"{path}/{BATCH}={int(batch_id)}")


def rotate_log(spark: SparkSession, log_path: str, consumed_upto: int, out_path: str) -> int:
    """OP-10/11 without the lost-rows race: batches up to a fixed id were
    consumed; the later ones are kept in a new log version at ``out_path``.
    Batch ids grow with arrival, so what arrived meanwhile stays."""
    left = spark.read.parquet(log_path).filter(F.col(BATCH) > F.lit(consumed_upto))
    return write_counted(left, out_path, [BATCH])


def promotion_decisions(runs: DataFrame, score: str, order: Sequence[str],
                        mode: str = "minimize", key: Sequence[str] = ()) -> DataFrame:
    """OP-94: walk candidate runs in order; a run is promoted when no
    champion exists yet or its score is strictly better than the best
    promoted so far (= best of all earlier runs). The running best is a
    window over the runs table (one row per training run)."""
    if mode not in ("minimize", "maximize"):
        raise ValueError(f"unknown promotion mode {mode}")
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    best_before = F.min(score).over(w) if mode == "minimize" else F.max(score).over(w)
    better = F.col(score) < F.col("champion_score") if mode == "minimize" else \
        F.col(score) > F.col("champion_score")
    return (runs.withColumn("champion_score", best_before)
                .withColumn("promoted", F.col("champion_score").isNull() | better)
                .withColumn("delta_vs_champion", F.col(score) - F.col("champion_score")))


def metric_tags(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """OP-95: metric values as 4-decimal tag strings."""
    return df.withColumns({f"{m}_tag": F.format_string("%.4f", F.col(m)) for m in metrics})
