"""Readers for the parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it.

    The tables hold naive (``TIMESTAMP_NTZ``) times; the session time zone is
    pinned to UTC so that casts to instants (watermarks, windows, epoch
    seconds) keep the wall-clock values on any machine."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(table_path(sf_dir, name))


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose tables as temp views so SQL-string sources (OP-06) can read them."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)
