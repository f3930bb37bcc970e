"""Monitoring tables: table summaries (OP-13/98), latest listings (OP-14),
rolling std (OP-35), top groups (OP-36/37/100), champion comparison (OP-97),
model age (OP-99), prediction counter (OP-101), histograms (OP-102), alarm
state timeline (OP-109) and champion metric seeding (OP-110)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skydrift.functions.exprs import clean_metric
from skydrift.functions.frames import with_scalars
from skydrift.operators import metrics as M
from skydrift.session import materialize


def table_summary(tables: Mapping[str, DataFrame], date_col: str) -> DataFrame:
    """One row per table: ``count(*), min(date), max(date)`` (one agg each)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"),
                    F.min(date_col).alias("min_date"),
                    F.max(date_col).alias("max_date"))
               .select(F.lit(name).alias("table_name"), "row_count", "min_date", "max_date")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def newest_first(ts_col: str, id_col: str) -> list:
    """Newest-first total order: timestamp desc, then id desc (ties in a
    batch that shares one timestamp are broken by id)."""
    return [F.col(ts_col).desc(), F.col(id_col).desc()]


def rolling_std_last(df: DataFrame, value: str, ts_col: str, id_col: str,
                     n: int = 100, window: int = 5000, legacy_tail: bool = False) -> DataFrame:
    """Sample std of the newest ``n`` values (whole frame when fewer).

    ``legacy_tail`` reproduces the original behaviour: the *oldest* ``n``
    of the newest ``window`` rows."""
    if legacy_tail:
        batch = df.orderBy(*newest_first(ts_col, id_col)).limit(window)
        picked = batch.orderBy(F.col(ts_col).asc(), F.col(id_col).asc()).limit(n)
    else:
        picked = df.orderBy(*newest_first(ts_col, id_col)).limit(n)
    return picked.agg(F.stddev_samp(value).alias("rolling_std"))


def rolling_std_window(df: DataFrame, value: str, partition: Sequence[str],
                       order: Sequence[str], n: int = 100) -> DataFrame:
    """Rolling sample std over the trailing ``n`` rows within a key, in
    ``order`` (a total order within the key). NULL keys are a key like others.

    A window over the key alone would make a key that holds a third of all rows
    one task. So the rows are ranged by key and order, and each range gets the
    last ``n - 1`` rows of the key before it (its halo); the window is then
    over the ranges, and the halo's own results are dropped."""
    keys = list(partition)
    full = [F.asc_nulls_first(c) for c in (*keys, *order)]
    ranged = df.repartitionByRange(*full).sortWithinPartitions(*full) \
        .withColumn("_rid", F.monotonically_increasing_id()).withColumn("_pid", F.spark_partition_id())
    ranged = materialize(ranged)  # the halo and the ranges must see one layout
    # a row for each key of each range; a key's rows lie together in it
    runs = ranged.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_n"), F.max("_rid").alias("_last"))
    along = Window.partitionBy(*keys).orderBy("_pid")
    upto = F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, 0))
    # a later range needs a row if fewer than n - 1 rows of the key lie between;
    # each range has one at least, so n - 1 ranges ahead are enough
    ahead = along.rowsBetween(1, n - 1)
    spans = runs.withColumn("_upto", upto).withColumn("_before", F.col("_upto") - F.col("_n")) \
        .withColumn("_ahead", F.collect_list(F.struct("_pid", "_before")).over(ahead)) \
        .filter(F.size("_ahead") > 0).select(F.col("_pid").alias("_from"), "_last", "_upto", "_ahead")
    # one row at most per range: its last key is the only one that goes on
    behind = F.col("_last") - F.col("_rid")
    needed = F.filter("_ahead", lambda x: behind + x["_before"] - F.col("_upto") < n - 1)
    halo = ranged.join(spans, (F.col("_pid") == F.col("_from")) & (F.col("_rid") <= F.col("_last")) & (behind < n - 1)) \
        .select(*df.columns, "_rid", F.explode(needed).alias("_to")) \
        .select(*df.columns, "_rid", F.col("_to._pid").alias("_pid"), F.lit(True).alias("_halo"))
    rows = ranged.select(*df.columns, "_rid", "_pid", F.lit(False).alias("_halo")).unionByName(halo)
    w = Window.partitionBy("_pid", *keys).orderBy("_rid").rowsBetween(-(n - 1), 0)
    return rows.withColumn("rolling_std", F.stddev_samp(value).over(w)).filter(~F.col("_halo")) \
        .select(*df.columns, "rolling_std")


def top_groups(df: DataFrame, group: str, value: str, k: int = 3,
               out_value: str = "rate") -> DataFrame:
    """Top-k groups by mean value, rank 1..k; ties broken by the group key.
    Aggregation is partial (map-side); only k rows reach the final sort."""
    agg = df.groupBy(group).agg(F.avg(value).alias(out_value))
    top = agg.orderBy(F.col(out_value).desc(), F.col(group).asc()).limit(k)
    # window over at most k rows
    w = Window.orderBy(F.col(out_value).desc(), F.col(group).asc())
    return top.withColumn("rank", F.row_number().over(w))


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """Most frequent non-NULL value (smallest value on count ties)."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).count()
    return counts.orderBy(F.col("count").desc(), F.col(column).asc()).limit(1) \
        .select(F.col(column).alias("top_value"), F.col("count").alias("top_count"))


def champion_comparison(champion: DataFrame, current: DataFrame) -> DataFrame:
    """Join champion metrics with current metrics by name (both long frames
    ``(name, value)``); ``delta = current - champion``."""
    c = champion.select("name", F.col("value").alias("champion_value"))
    n = current.select("name", F.col("value").alias("current_value"))
    return c.join(n, "name", "full_outer").withColumn(
        "delta", F.col("current_value") - F.col("champion_value"))


def model_age_hours(runs: DataFrame, now_ts: str, start_col: str = "start_ts") -> DataFrame:
    """Hours since run start, with ``now`` passed in (testable)."""
    now = F.to_timestamp(F.lit(now_ts))
    return runs.withColumn(
        "age_hours", (F.unix_timestamp(now) - F.unix_timestamp(F.col(start_col))) / 3600.0)


def prediction_counter(df: DataFrame, ts_col: str, unit: str = "hour") -> DataFrame:
    """Predictions per time bucket and the cumulative counter. The running
    sum is over the aggregated buckets (one row per bucket), not over rows."""
    ts_type = dict((f.name, f.dataType) for f in df.schema.fields)[ts_col]
    per = df.groupBy(F.date_trunc(unit, F.col(ts_col)).cast(ts_type).alias("bucket")) \
        .agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    return per.withColumn("cumulative", F.sum("n").over(w))


def histogram(df: DataFrame, value: str, lo: float, hi: float, buckets: int,
              by: Sequence[str] = ()) -> DataFrame:
    """Bucketed observation: ``width_bucket`` counts per bucket and the
    cumulative ``le`` count (buckets 0 and n+1 hold out-of-range values)."""
    b = F.width_bucket(F.col(value), F.lit(lo), F.lit(hi), F.lit(buckets))
    per = df.groupBy(*by, b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*by).orderBy("bucket") \
        .rowsBetween(Window.unboundedPreceding, 0) if by else \
        Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    return per.withColumn("le_count", F.sum("n").over(w))


def alarm_timeline(events: DataFrame, model_col: str = "model", ts_col: str = "ts",
                   kind_col: str = "kind") -> DataFrame:
    """State per event row. ``drift`` sets alarm=1, retrain=0; ``promote``
    sets alarm=0, retrain=1; other kinds carry the last state forward.
    ``episode`` counts drift alarms so far. Window per model key."""
    k = F.col(kind_col)
    alarm_set = F.when(k == "drift", 1).when(k == "promote", 0)
    retrain_set = F.when(k == "drift", 0).when(k == "promote", 1)
    prio = F.when(k == "drift", 0).when(k == "promote", 1).otherwise(2)
    w = Window.partitionBy(model_col).orderBy(F.col(ts_col), prio) \
        .rowsBetween(Window.unboundedPreceding, 0)
    return (events
            .withColumn("alarm", F.coalesce(F.last(alarm_set, ignorenulls=True).over(w), F.lit(0)))
            .withColumn("retrain", F.coalesce(F.last(retrain_set, ignorenulls=True).over(w),
                                              F.lit(0)))
            .withColumn("episode", F.sum(F.when(k == "drift", 1).otherwise(0)).over(w)))


def metric_series_seed(champion: DataFrame, metric_names: Sequence[str],
                       model_name: str, alias: str = "champion",
                       drift_start: float = 0.05) -> DataFrame:
    """Long metric rows seeded from the champion's metric map, plus the
    starting drift value and the version label ``name_vN@alias``."""
    label = F.format_string("%s_v%d@%s", F.lit(model_name), F.col("version"), F.lit(alias))
    rows = champion.select(
        label.alias("champion_label"),
        F.explode(F.map_concat(
            F.map_from_arrays(F.array(*[F.lit(m) for m in metric_names]),
                              F.array(*[F.col("metrics").getItem(m) for m in metric_names])),
            F.create_map(F.lit("drift_score"), F.lit(drift_start)))).alias("name", "value"))
    return rows


#: The figures of a monitoring batch, in the order of its row.
BATCH_METRICS = ("mae", "rmse", "actual_rate", "predicted_rate", "f1", "roc_auc_hard", "accuracy", "precision",
                 "recall", "specificity", "rate_delta", "top_origin", "r2", "residual_skewness", "rolling_std",
                 "confidence_mean")


def batch_metrics(batch: DataFrame, ts_col: str = "ts", id_col: str = "id") -> DataFrame:
    """All figures of one monitoring batch (labelled log rows) as long rows
    ``(name, value)``: regression, classification (0 unless the truth holds both
    classes), rates, the most frequent origin, and the spread of the newest 100
    predictions. NULL, NaN and infinite figures are 0, so an empty batch is a
    full set of zeros."""
    y, p = "true_class", "prediction_class"
    parts = [
        M.regression_metrics(batch, "true_reg", "prediction_reg", with_median=False).drop("n"),
        M.classification_metrics(batch, y, p, proba="prediction_class_proba").drop("n"),
        M.delay_rates(batch, y, p).drop("n"),
        rolling_std_last(batch, "prediction_reg", ts_col, id_col),
        most_frequent(batch, "origin_airport_id").agg(F.first("top_value").cast("double").alias("top_origin")),
    ]
    row = reduce(with_scalars, parts)
    return row.select([clean_metric(F.col(c).cast("double")).alias(c) for c in BATCH_METRICS]) \
        .unpivot([], list(BATCH_METRICS), "name", "value")
