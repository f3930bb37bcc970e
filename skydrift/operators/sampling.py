"""Filters and samplers: date ranges (OP-18), calendar month (OP-19),
ordered limits (OP-14/33/34), hash sample (OP-38), Bernoulli (OP-39), seeded
fixed size (OP-40), late materialisation semi-join (OP-28), size
equalisation (OP-42), staged downsampling (OP-43), monthly batches (OP-44)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skydrift.functions.exprs import md5_bucket
from skydrift.operators.positions import before, rows_at

def date_range(df: DataFrame, col: str, start: str, end: str) -> DataFrame:
    """Half-open ``start <= col < end`` (end exclusive); prunes partitions
    and parquet row groups when the table is laid out by date."""
    c = F.col(col)
    return df.filter((c >= F.lit(start).cast("date")) & (c < F.lit(end).cast("date")))


def ordered_limit(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows in ascending ``order`` (a total order), for any ``n``:
    the row at position ``n`` is found on the order columns alone, and the
    source is filtered by it. No task merges or holds ``n`` rows."""
    return df.filter(before(df, order, rows_at(df, order, [n]).get(n)))


def earliest_n(df: DataFrame, date_col: str, key_col: str, n: int) -> DataFrame:
    return ordered_limit(df, [date_col, key_col], n)


def latest_n(df: DataFrame, ts_col: str, id_col: str, n: int) -> DataFrame:
    """Newest ``n`` rows; ties in the timestamp are broken by id (desc). The
    monitoring window is small by definition, so each task keeps its own newest
    ``n`` and only those are merged."""
    return df.orderBy(F.col(ts_col).desc(), F.col(id_col).desc()).limit(n)


def hash_sample(df: DataFrame, key: str, per_mille: int = 10, modulus: int = 1000) -> DataFrame:
    """Deterministic key sample: ``md5 bucket < per_mille`` of ``modulus``.
    Narrow (no shuffle); the same keys are picked on every run and engine."""
    return df.filter(md5_bucket(key, modulus) < per_mille)


def seeded_unit(key: str, seed: int | str) -> Column:
    """A number in [0, 1) from md5 of ``seed || key``: the same for a key on any
    engine, run and layout of the rows."""
    return md5_bucket(F.concat(F.lit(str(seed)), F.col(key).cast("string")), 1 << 30) / F.lit(float(1 << 30))


def bernoulli(df: DataFrame, fraction: float, key: str, seed: int) -> DataFrame:
    """Independent inclusion of each key with probability ``fraction``. Unlike a
    generator per partition, a lost and recomputed task draws the same rows."""
    return df.filter(seeded_unit(key, seed) < fraction)


def seeded_order_key(key: str, seed: int | str) -> Column:
    """Engine-independent pseudo-random order: md5 of ``seed || key``."""
    return F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string")))


def seeded_fixed_size(df: DataFrame, key: str, n: int, seed: int | str) -> DataFrame:
    """Uniform sample of exactly ``min(n, count)`` rows, reproducible."""
    placed = df.withColumn("_o", seeded_order_key(key, seed))
    return ordered_limit(placed, ["_o", key], n).drop("_o")


def semi_join_keys(base: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Late materialisation: pick keys on a narrow projection, then fetch the
    wide rows with a left-semi join, planned from the key side's real size."""
    return base.join(keys.select(key), key, "left_semi")


def equalise(reference: DataFrame, current: DataFrame, key: str,
             seeds: tuple[int, int] = (42, 24)) -> tuple[DataFrame, DataFrame]:
    """Downsample both sides to ``min(|ref|, |cur|)`` rows in seeded order."""
    keep = min(reference.count(), current.count())
    return (seeded_fixed_size(reference, key, keep, seeds[0]),
            seeded_fixed_size(current, key, keep, seeds[1]))


def staged_downsample(df: DataFrame, fractions: Sequence[float], max_rows: int, key: str,
                      seed: int = 42) -> DataFrame:
    """Drop a ``fraction`` of the rows per stage; after each stage, stop if
    fewer than ``max_rows`` are left. Iterative by nature: one count per stage
    (a scalar), the data never leaves the executors."""
    out = df
    for i, f in enumerate(fractions):
        out = bernoulli(out, 1.0 - f, key, seed + i)
        if out.count() < max_rows:
            break
    return out


def monthly_batches(df: DataFrame, date_col: str, aggs: Sequence[Column]) -> DataFrame:
    """All monthly batches in one job: group by ``trunc(date, 'MM')``."""
    start = F.trunc(F.col(date_col), "MM")
    return (df.groupBy(start.alias("batch_start"))
              .agg(*aggs)
              .withColumn("batch_end", F.add_months(F.col("batch_start"), 1)))
