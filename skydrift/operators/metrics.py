"""Evaluation metrics as one-pass aggregates, ungrouped or grouped by any
keys (month, airline, batch): regression (OP-69..72), classification and
confusion counts (OP-73, 74, 76..78), exact ROC-AUC (OP-75), regression as
classifier (OP-26, 79), score selection (OP-80) and empty/NaN guards (OP-27,
81). All aggregates are partial (map-side combined) before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skydrift.functions.exprs import clean_metric, safe_ratio
from skydrift.functions.frames import join_null_safe, with_scalars
from skydrift.operators.positions import exact_median, running_totals


def _agg(df: DataFrame, by: Sequence[str], exprs: list[Column]) -> DataFrame:
    return df.groupBy(*by).agg(*exprs) if by else df.agg(*exprs)


def regression_metrics(df: DataFrame, y: str, p: str, by: Sequence[str] = (),
                       with_median: bool = True) -> DataFrame:
    """n, MAE, MSE, RMSE, R^2 and residual skewness (population g1 of
    ``y - p``) in one aggregate; median absolute error from exact positions
    (no group's values held in one task). Rows without a truth or a prediction
    count in none of them; a group of such rows only has n = 0."""
    e = F.col(y) - F.col(p)
    moments = _agg(df, by, [
        F.count(e).alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e * e).alias("mse"),
        F.sum(e * e).alias("_sse"),
        F.var_pop(F.when(e.isNotNull(), F.col(y))).alias("_vy"),
        F.skewness(e).alias("residual_skewness"),
    ])
    res = moments.select(
        *by, "n", "mae", "mse", F.sqrt("mse").alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("n") * F.col("_vy"))).alias("r2"),
        "residual_skewness")
    if with_median:
        med = exact_median(df.select(*by, F.abs(e).alias("_ae")), "_ae", by, "medae")
        res = join_null_safe(res, med, list(by), "left") if by else with_scalars(res, med)
    return res


def confusion_counts(y: str, p: str) -> list[Column]:
    yc, pc = F.col(y), F.col(p)
    return [F.sum(F.when((yc == 1) & (pc == 1), 1).otherwise(0)).cast("bigint").alias("tp"),
            F.sum(F.when((yc == 0) & (pc == 0), 1).otherwise(0)).cast("bigint").alias("tn"),
            F.sum(F.when((yc == 0) & (pc == 1), 1).otherwise(0)).cast("bigint").alias("fp"),
            F.sum(F.when((yc == 1) & (pc == 0), 1).otherwise(0)).cast("bigint").alias("fn")]


def classification_metrics(df: DataFrame, y: str, p: str, by: Sequence[str] = (),
                           proba: str | None = None, guard: bool = True) -> DataFrame:
    """Accuracy, precision, recall, F1, specificity (0 on zero denominators),
    hard-label AUC ``(TPR+TNR)/2`` and mean class-1 probability.

    Rows without a truth or a prediction are not counted.
    ``guard``: metrics are 0 unless the truth holds both classes; for a 0/1
    label ``count(distinct y) = 2`` is ``min(y) < max(y)``, which needs no
    distinct aggregation."""
    aggs = confusion_counts(y, p) + [
        F.count(F.col(y) + F.col(p)).alias("n"),
        (F.min(y) < F.max(y)).alias("_both"),
    ]
    if proba:
        aggs.append(F.avg(proba).alias("confidence_mean"))
    c = _agg(df, by, aggs)
    tp, tn, fp, fn = (F.col(x) for x in ("tp", "tn", "fp", "fn"))
    precision = safe_ratio(tp, tp + fp)
    recall = safe_ratio(tp, tp + fn)
    spec = safe_ratio(tn, tn + fp)
    metrics = {
        "accuracy": safe_ratio(tp + tn, F.col("n")),
        "precision": precision,
        "recall": recall,
        "f1": safe_ratio(F.lit(2.0) * tp, F.lit(2.0) * tp + fp + fn),
        "specificity": spec,
        "roc_auc_hard": (recall + spec) / 2.0,
    }
    ok = F.coalesce(F.col("_both"), F.lit(False)) if guard else F.lit(True)
    cols = [F.when(ok, v).otherwise(F.lit(0.0)).alias(k) for k, v in metrics.items()]
    extra = ["confidence_mean"] if proba else []
    return c.select(*by, "n", "tp", "tn", "fp", "fn", *cols,
                    *[clean_metric(x).alias(x) for x in extra])


def confusion_matrix(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """Long confusion matrix ``(y, p, count, share_of_true_row)``. The row
    normalisation is a window over the tiny aggregated matrix."""
    cm = df.groupBy(*by, F.col(y).alias("y_true"), F.col(p).alias("y_pred")) \
        .agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(*by, "y_true")
    return cm.withColumn("row_share", F.col("count") / F.sum("count").over(w))


def roc_auc(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact ROC-AUC with ties counted 1/2 (Mann-Whitney):
    ``sum_s pos(s) * (neg(<s) + neg(s)/2) / (P * N)``.

    Pre-aggregated to one row per (group, score) map-side; the running count
    of negatives below each score uses range-partitioned running totals,
    never a window over all scores in one task. Rows without a truth or a score
    are left out; a group of such rows only has no row."""
    per = df.filter(F.col(y).isNotNull() & F.col(score).isNotNull()).groupBy(*by, F.col(score).cast("double").alias("_s")).agg(
        F.sum(F.when(F.col(y) == 1, 1).otherwise(0)).cast("double").alias("_pos"),
        F.sum(F.when(F.col(y) == 1, 0).otherwise(1)).cast("double").alias("_neg"))
    run = running_totals(per, list(by), ["_s"], ["_neg"])
    contrib = F.col("_pos") * (F.col("cum__neg") - F.col("_neg") / 2.0)
    out = _agg(run, by, [F.sum(contrib).alias("_u"), F.sum("_pos").alias("_P"),
                         F.sum("_neg").alias("_N")])
    return out.select(*by, F.coalesce(F.try_divide(F.col("_u"), F.col("_P") * F.col("_N")),
                                      F.lit(0.0)).alias("roc_auc"))


def delay_rates(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """Actual rate, predicted rate and delta = predicted - actual."""
    r = _agg(df, by, [F.count(F.lit(1)).alias("n"),
                      F.avg(F.col(y).cast("double")).alias("actual_rate"),
                      F.avg(F.col(p).cast("double")).alias("predicted_rate")])
    return r.withColumn("rate_delta", F.col("predicted_rate") - F.col("actual_rate"))


def regression_as_classifier(df: DataFrame, y_cls: str, p_reg: str, threshold: float = 15.0,
                             by: Sequence[str] = ()) -> DataFrame:
    """``pred > threshold`` (strict) against the binary truth; AUC uses the
    raw regression value as the score."""
    d = df.withColumn("_pbin", (F.col(p_reg) > F.lit(threshold)).cast("int"))
    cls = classification_metrics(d, y_cls, "_pbin", by, guard=False)
    auc = roc_auc(d, y_cls, p_reg, by)
    if not by:
        return with_scalars(cls, auc)
    return join_null_safe(cls, auc, list(by), "left").withColumn("roc_auc", F.coalesce("roc_auc", F.lit(0.0)))


def select_score(metrics: dict, config: dict, default: str) -> tuple[str, float]:
    """tuning_metric, else promotion_metric, else ``default``. Unknown names
    raise (the original silently took the first metric)."""
    name = config.get("tuning_metric") or config.get("promotion_metric") or default
    if name not in metrics:
        raise ValueError(f"unknown metric {name!r}; have {sorted(metrics)}")
    return name, float(metrics[name])


def guarded(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NaN / Inf / NULL -> 0.0 on the listed metric columns (an empty batch
    therefore reports all zeros)."""
    return df.withColumns({c: clean_metric(c) for c in cols})
