"""Frame helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach every column of a one-row aggregate to each row of ``df``.

    The one-row frame becomes a single struct-valued scalar subquery:
    evaluated once, embedded in the plan -- no join, no pairing of rows."""
    cols = one_row.columns
    s = one_row.select(F.struct(*[F.col(c) for c in cols]).alias("_s")).scalar()
    return df.withColumn("_s", s).select(*[F.col(c) for c in df.columns],
                                         *[F.col(f"_s.{c}").alias(c) for c in cols])


def join_null_safe(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``a`` joined to ``b`` on equal keys, NULL being equal to NULL (plain
    equality loses the groups of a nullable key). Keys come from ``a``."""
    right = b.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in b.columns])
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return a.join(right, on, how).drop(*[f"_r_{k}" for k in keys])
