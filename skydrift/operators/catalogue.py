"""Catalogue tables laid out in buckets (OP-04, 07, 08, 28).

A table bucketed and sorted by its key is joined on that key without a shuffle
of its rows: only the other side is dealt to the buckets."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str,
                  sort_by: Sequence[str] = ()) -> DataFrame:
    """OP-07: ``df`` as the catalogue table ``name`` with its files at ``path``,
    in ``buckets`` buckets by ``key``. The rows are dealt by the key first, so each
    bucket is one file and not one per task; a key has one row here."""
    df.repartition(buckets, key).write.mode("overwrite").option("path", path) \
        .bucketBy(buckets, key).sortBy(key, *sort_by).saveAsTable(name)
    return df.sparkSession.table(name)


def load_once(spark: SparkSession, name: str, build: Callable[[], DataFrame], key: str, buckets: int, path: str) -> tuple[DataFrame, bool]:
    """OP-04: the table, built if the catalogue lacks it; and whether it was."""
    if spark.catalog.tableExists(name):
        return spark.table(name), False
    return save_bucketed(build(), name, key, buckets, path), True


def clone_like(spark: SparkSession, source: str, name: str, path: str) -> bool:
    """OP-08: an empty table with the columns and buckets of another, unless it
    exists; returns whether it was made."""
    if spark.catalog.tableExists(name):
        return False
    spark.sql(f"CREATE TABLE {name} LIKE {source} USING parquet LOCATION '{path}'")
    return True


def semi_join(wide: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """OP-28: the rows of a bucketed table whose key is among ``keys``. The wide
    side is read bucket by bucket; whether the keys are broadcast or dealt to the
    buckets goes by their size."""
    return wide.join(keys.select(key), key, "left_semi")
