"""Evaluation metrics and monitoring figures over the predictions log
(OP-23, 26, 27, 35-37, 69-81, 100-102)."""

from __future__ import annotations

from pyspark.sql import functions as F

from skydrift.operators import metrics as M
from skydrift.operators import monitor as MON
from skydrift.plans.oracle import with_fx
from skydrift.plans.registry import query
from skydrift.sources.fixtures import fx_labels, fx_predictions

_REG_BODY = """
select {by_sel}count(*) as n,
       avg(abs(true_reg - prediction_reg)) as mae,
       avg((true_reg - prediction_reg) * (true_reg - prediction_reg)) as mse,
       sqrt(avg((true_reg - prediction_reg) * (true_reg - prediction_reg))) as rmse,
       1 - sum((true_reg - prediction_reg) * (true_reg - prediction_reg))
           / (count(*) * var_pop(true_reg)) as r2,
       avg(power(e - e_mean, 3)) / power(avg(power(e - e_mean, 2)), 1.5) as residual_skewness,
       median(abs(true_reg - prediction_reg)) as medae
from (select *, true_reg - prediction_reg as e,
             avg(true_reg - prediction_reg) over ({by_part}) as e_mean
      from fx_predictions) t
{group}"""


@query("regression_metrics", with_fx(["fx_predictions"], _REG_BODY.format(
    by_sel="", by_part="", group="")))
def q_regression_metrics(spark, sf_dir):
    """OP-69..72: MAE, MSE, RMSE, R^2, residual skewness (y - p), exact
    median absolute error."""
    return M.regression_metrics(fx_predictions(spark, sf_dir), "true_reg", "prediction_reg")


@query("regression_metrics_by_day", with_fx(["fx_predictions"], _REG_BODY.format(
    by_sel="cast(ts as date) as day, ", by_part="partition by cast(ts as date)",
    group="group by cast(ts as date)")))
def q_regression_metrics_by_day(spark, sf_dir):
    """The same aggregates per daily batch in one grouped job."""
    p = fx_predictions(spark, sf_dir).withColumn("day", F.to_date("ts"))
    return M.regression_metrics(p, "true_reg", "prediction_reg", by=["day"])


_CLS_BODY = """
select {by_sel}count_n as n, tp, tn, fp, fn,
       case when both_cls then coalesce((tp + tn) / nullif(count_n, 0), 0) else 0 end as accuracy,
       case when both_cls then coalesce(tp / nullif(tp + fp, 0), 0) else 0 end as precision,
       case when both_cls then coalesce(tp / nullif(tp + fn, 0), 0) else 0 end as recall,
       case when both_cls then coalesce(2.0 * tp / nullif(2.0 * tp + fp + fn, 0), 0) else 0 end as f1,
       case when both_cls then coalesce(tn / nullif(tn + fp, 0), 0) else 0 end as specificity,
       case when both_cls then (coalesce(tp / nullif(tp + fn, 0), 0)
                                + coalesce(tn / nullif(tn + fp, 0), 0)) / 2 else 0 end as roc_auc_hard
       {conf}
from (select {by_sel}count(*) as count_n,
             cast(sum(case when true_class = 1 and prediction_class = 1 then 1 else 0 end) as bigint) as tp,
             cast(sum(case when true_class = 0 and prediction_class = 0 then 1 else 0 end) as bigint) as tn,
             cast(sum(case when true_class = 0 and prediction_class = 1 then 1 else 0 end) as bigint) as fp,
             cast(sum(case when true_class = 1 and prediction_class = 0 then 1 else 0 end) as bigint) as fn,
             count(distinct true_class) = 2 as both_cls
             {conf_inner}
      from {src} {group}) c"""


def _cls_sql(src, by="", conf=False):
    return _CLS_BODY.format(
        by_sel=f"{by}, " if by else "", src=src, group=f"group by {by}" if by else "",
        conf=", confidence_mean" if conf else "",
        conf_inner=", avg(prediction_class_proba) as confidence_mean" if conf else "")


@query("classification_metrics", with_fx(["fx_predictions"],
                                         _cls_sql("fx_predictions", conf=True)))
def q_classification_metrics(spark, sf_dir):
    """OP-73, 74, 76, 78: confusion counts, ratios, confidence mean."""
    return M.classification_metrics(fx_predictions(spark, sf_dir), "true_class",
                                    "prediction_class", proba="prediction_class_proba")


@query("classification_metrics_imbalanced", with_fx(["fx_labels"], _cls_sql("fx_labels")))
def q_classification_metrics_labels(spark, sf_dir):
    """Imbalanced pair (quality vs toxic) exercising the zero-denominator rules."""
    return M.classification_metrics(fx_labels(spark, sf_dir), "true_class", "prediction_class")


@query("classification_metrics_by_user", with_fx(["fx_predictions"], _cls_sql(
    "fx_predictions", by="origin_airport_id")))
def q_classification_by_user(spark, sf_dir):
    """Grouped variant (150 groups); the both-classes guard applies per group."""
    return M.classification_metrics(fx_predictions(spark, sf_dir), "true_class",
                                    "prediction_class", by=["origin_airport_id"])


@query("confusion_matrix", with_fx(["fx_predictions"], """
select true_class as y_true, prediction_class as y_pred, count(*) as count,
       count(*) / sum(count(*)) over (partition by true_class) as row_share
from fx_predictions group by true_class, prediction_class"""))
def q_confusion_matrix(spark, sf_dir):
    return M.confusion_matrix(fx_predictions(spark, sf_dir), "true_class", "prediction_class")


_AUC_SQL = """
select {by_sel}coalesce(sum(pos * (cum_neg - neg / 2.0)) / (sum(pos) * sum(neg)), 0) as roc_auc
from (select {by_sel}s, pos, neg,
             sum(neg) over ({by_part} order by s rows between unbounded preceding and current row) as cum_neg
      from (select {by_sel}cast({score} as double) as s,
                   cast(sum(case when true_class = 1 then 1 else 0 end) as double) as pos,
                   cast(sum(case when true_class = 1 then 0 else 1 end) as double) as neg
            from {src} group by {by_sel}s) a) b
{group}"""


def _auc_sql(score, src="fx_predictions", by=""):
    return _AUC_SQL.format(by_sel=f"{by}, " if by else "", score=score, src=src,
                           by_part=f"partition by {by}" if by else "",
                           group=f"group by {by}" if by else "")


@query("roc_auc", with_fx(["fx_predictions"], _auc_sql("prediction_reg")))
def q_roc_auc(spark, sf_dir):
    """OP-75: exact AUC of a continuous score, ties 1/2."""
    return M.roc_auc(fx_predictions(spark, sf_dir), "true_class", "prediction_reg")


@query("roc_auc_proba_ties", with_fx(["fx_predictions"], _auc_sql("prediction_class_proba")))
def q_roc_auc_proba(spark, sf_dir):
    """AUC of a capped probability (many ties at 1.0)."""
    return M.roc_auc(fx_predictions(spark, sf_dir), "true_class", "prediction_class_proba")


@query("roc_auc_by_airline", with_fx(["fx_predictions"], _auc_sql(
    "prediction_reg", by="marketing_airline_network")))
def q_roc_auc_by(spark, sf_dir):
    return M.roc_auc(fx_predictions(spark, sf_dir), "true_class", "prediction_reg",
                     by=["marketing_airline_network"])


@query("regression_as_classifier", with_fx(["fx_predictions"], """
select c.*, a.roc_auc from
(select count_n as n, tp, tn, fp, fn,
        coalesce((tp + tn) / nullif(count_n, 0), 0) as accuracy,
        coalesce(tp / nullif(tp + fp, 0), 0) as precision,
        coalesce(tp / nullif(tp + fn, 0), 0) as recall,
        coalesce(2.0 * tp / nullif(2.0 * tp + fp + fn, 0), 0) as f1,
        coalesce(tn / nullif(tn + fp, 0), 0) as specificity,
        (coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0)) / 2 as roc_auc_hard
 from (select count(*) as count_n,
        cast(sum(case when true_class = 1 and prediction_reg > 15 then 1 else 0 end) as bigint) as tp,
        cast(sum(case when true_class = 0 and not prediction_reg > 15 then 1 else 0 end) as bigint) as tn,
        cast(sum(case when true_class = 0 and prediction_reg > 15 then 1 else 0 end) as bigint) as fp,
        cast(sum(case when true_class = 1 and not prediction_reg > 15 then 1 else 0 end) as bigint) as fn
       from fx_predictions) x) c,
(""" + _auc_sql("prediction_reg") + ") a"))
def q_regression_as_classifier(spark, sf_dir):
    """OP-26 + OP-79: strict pred > 15 as the class; AUC on the raw value."""
    return M.regression_as_classifier(fx_predictions(spark, sf_dir), "true_class",
                                      "prediction_reg", 15.0)


@query("delay_rates", with_fx(["fx_predictions"], """
select marketing_airline_network, count(*) as n,
       avg(cast(true_class as double)) as actual_rate,
       avg(cast(prediction_class as double)) as predicted_rate,
       avg(cast(prediction_class as double)) - avg(cast(true_class as double)) as rate_delta
from fx_predictions group by marketing_airline_network"""))
def q_delay_rates(spark, sf_dir):
    """OP-77: actual / predicted rate and their delta per airline."""
    return M.delay_rates(fx_predictions(spark, sf_dir), "true_class", "prediction_class",
                         by=["marketing_airline_network"])


@query("labelled_only", with_fx(["fx_predictions"], """
select count(*) as labelled_rows, round(avg(true_reg), 6) as avg_true_reg
from fx_predictions where true_reg is not null and true_class is not null"""))
def q_labelled_only(spark, sf_dir):
    """OP-23: rows without both truths are dropped before metrics."""
    from skydrift.operators.staging import drop_missing
    d = drop_missing(fx_predictions(spark, sf_dir), ["true_reg", "true_class"])
    return d.agg(F.count(F.lit(1)).alias("labelled_rows"),
                 F.round(F.avg("true_reg"), 6).alias("avg_true_reg"))


@query("rolling_std_last100", with_fx(["fx_predictions"], """
select stddev_samp(prediction_reg) as rolling_std
from (select prediction_reg from fx_predictions order by ts desc, id desc limit 100) t"""))
def q_rolling_std(spark, sf_dir):
    """OP-35: sample std of the newest 100 predictions."""
    return MON.rolling_std_last(fx_predictions(spark, sf_dir), "prediction_reg", "ts", "id")


@query("rolling_std_legacy_tail", with_fx(["fx_predictions"], """
select stddev_samp(prediction_reg) as rolling_std
from (select prediction_reg from
        (select * from fx_predictions order by ts desc, id desc limit 5000) b
      order by ts asc, id asc limit 100) t"""))
def q_rolling_std_legacy(spark, sf_dir):
    """The original's tail: oldest 100 of the newest 5000."""
    return MON.rolling_std_last(fx_predictions(spark, sf_dir), "prediction_reg", "ts", "id",
                                legacy_tail=True)


@query("rolling_std_window", with_fx(["fx_predictions"], """
select id, stddev_samp(prediction_reg) over (partition by marketing_airline_network
         order by ts, id rows between 99 preceding and current row) as rolling_std
from fx_predictions"""))
def q_rolling_std_window(spark, sf_dir):
    """True rolling std over the trailing 100 rows per airline key."""
    r = MON.rolling_std_window(fx_predictions(spark, sf_dir), "prediction_reg",
                               ["marketing_airline_network"], ["ts", "id"], 100)
    return r.select("id", "rolling_std")


@query("top3_groups", with_fx(["fx_predictions"], """
select marketing_airline_network, rate,
       cast(row_number() over (order by rate desc, marketing_airline_network) as integer) as rank
from (select marketing_airline_network, avg(prediction_class) as rate
      from fx_predictions group by 1 order by rate desc, marketing_airline_network limit 3) t"""))
def q_top3(spark, sf_dir):
    """OP-36 / OP-100: top-3 airlines by predicted delay rate, ranked."""
    return MON.top_groups(fx_predictions(spark, sf_dir), "marketing_airline_network",
                          "prediction_class", 3)


@query("top_origin", with_fx(["fx_predictions"], """
select origin_airport_id as top_value, count(*) as top_count from fx_predictions
where origin_airport_id is not null
group by 1 order by top_count desc, top_value limit 1"""))
def q_top_origin(spark, sf_dir):
    """OP-37: most frequent origin (smallest id on ties)."""
    return MON.most_frequent(fx_predictions(spark, sf_dir), "origin_airport_id")


@query("top_delayed_origin", with_fx(["fx_predictions"], """
select origin_airport_id, rate,
       cast(row_number() over (order by rate desc, origin_airport_id) as integer) as rank
from (select origin_airport_id, avg(true_class) as rate from fx_predictions
      group by 1 order by rate desc, origin_airport_id limit 1) t"""))
def q_top_delayed_origin(spark, sf_dir):
    """Q13: the most *delayed* origin, named separately from the most frequent."""
    return MON.top_groups(fx_predictions(spark, sf_dir), "origin_airport_id", "true_class", 1)


@query("prediction_histogram", with_fx(["fx_predictions"], """
select marketing_airline_network, bucket, n,
       cast(sum(n) over (partition by marketing_airline_network order by bucket
                    rows between unbounded preceding and current row) as bigint) as le_count
from (select marketing_airline_network,
             case when prediction_reg < 0 then 0
                  when prediction_reg >= 100 then 11
                  else cast(floor(prediction_reg / 10) as bigint) + 1 end as bucket,
             count(*) as n
      from fx_predictions group by 1, 2) t"""))
def q_histogram(spark, sf_dir):
    """OP-102: distribution of predictions per batch key, with ``le`` counts."""
    return MON.histogram(fx_predictions(spark, sf_dir), "prediction_reg", 0.0, 100.0, 10,
                         by=["marketing_airline_network"])


@query("prediction_counter", with_fx(["fx_predictions"], """
select date_trunc('hour', ts) as bucket, count(*) as n,
       cast(sum(count(*)) over (order by date_trunc('hour', ts)
                           rows between unbounded preceding and current row) as bigint) as cumulative
from fx_predictions group by 1"""))
def q_counter(spark, sf_dir):
    """OP-101: predictions per hour and the cumulative counter."""
    return MON.prediction_counter(fx_predictions(spark, sf_dir), "ts", "hour")


@query("metric_guards", with_fx(["fx_predictions"], """
select cast(count(*) as bigint) as n,
       coalesce(avg(abs(true_reg - prediction_reg)), 0.0) as mae,
       coalesce(sqrt(avg((true_reg - prediction_reg) * (true_reg - prediction_reg))), 0.0) as rmse,
       coalesce(avg(cast(true_class as double)), 0.0) as actual_rate,
       coalesce(avg(cast(prediction_class as double)), 0.0) as predicted_rate,
       coalesce(avg(prediction_class_proba), 0.0) as confidence_mean
from fx_predictions where ts > (select max(ts) from fx_predictions)"""))
def q_metric_guards(spark, sf_dir):
    """OP-27/81: the batch after the newest prediction is empty; every metric
    reports 0 instead of NULL/NaN."""
    p = fx_predictions(spark, sf_dir)
    batch = p.filter(F.col("ts") > p.agg(F.max("ts")).scalar())
    e = F.col("true_reg") - F.col("prediction_reg")
    raw = batch.agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"),
                    F.sqrt(F.avg(e * e)).alias("rmse"),
                    F.avg(F.col("true_class").cast("double")).alias("actual_rate"),
                    F.avg(F.col("prediction_class").cast("double")).alias("predicted_rate"),
                    F.avg("prediction_class_proba").alias("confidence_mean"))
    return M.guarded(raw, ["mae", "rmse", "actual_rate", "predicted_rate", "confidence_mean"])


_BATCH_SQL = """batch AS (
  select *, row_number() over (order by ts desc, id desc) as newest from (
    select * from fx_predictions order by ts desc, id desc limit 5000) t
  where true_reg is not null and true_class is not null),
sums AS (
  select avg(abs(true_reg - prediction_reg)) as mae,
         sqrt(avg((true_reg - prediction_reg) * (true_reg - prediction_reg))) as rmse,
         1 - sum((true_reg - prediction_reg) * (true_reg - prediction_reg)) / (count(*) * var_pop(true_reg)) as r2,
         avg(cast(true_class as double)) as actual_rate, avg(cast(prediction_class as double)) as predicted_rate,
         avg(prediction_class_proba) as confidence_mean,
         avg(true_reg - prediction_reg) as em, stddev_pop(true_reg - prediction_reg) as es,
         sum(case when true_class = 1 and prediction_class = 1 then 1.0 else 0 end) as tp,
         sum(case when true_class = 0 and prediction_class = 0 then 1.0 else 0 end) as tn,
         sum(case when true_class = 0 and prediction_class = 1 then 1.0 else 0 end) as fp,
         sum(case when true_class = 1 and prediction_class = 0 then 1.0 else 0 end) as fn,
         stddev_samp(prediction_reg) filter (newest <= 100) as rolling_std
  from batch),
skew AS (select avg(power((true_reg - prediction_reg - em) / es, 3)) as residual_skewness from batch, sums),
top AS (select cast(origin_airport_id as double) as top_origin from batch where origin_airport_id is not null
        group by origin_airport_id order by count(*) desc, origin_airport_id limit 1)"""


@query("monitor_batch_metrics", with_fx(["fx_predictions"], """
select unnest(['mae', 'rmse', 'actual_rate', 'predicted_rate', 'f1', 'roc_auc_hard', 'accuracy', 'precision', 'recall',
               'specificity', 'rate_delta', 'top_origin', 'r2', 'residual_skewness', 'rolling_std', 'confidence_mean']) as name,
       unnest([mae, rmse, actual_rate, predicted_rate, 2 * tp / (2 * tp + fp + fn), (tp / (tp + fn) + tn / (tn + fp)) / 2,
               (tp + tn) / (tp + tn + fp + fn), tp / (tp + fp), tp / (tp + fn), tn / (tn + fp),
               predicted_rate - actual_rate, top_origin, r2, residual_skewness, rolling_std, confidence_mean]) as value
from sums, skew, top""", _BATCH_SQL))
def q_monitor_batch(spark, sf_dir):
    """OP-14/27/35/36/69-78: all figures of the newest labelled log rows at
    once, as rows of the metrics table."""
    from skydrift.operators.sampling import latest_n
    log = latest_n(fx_predictions(spark, sf_dir), "ts", "id", 5000)
    return MON.batch_metrics(log.filter("true_reg is not null and true_class is not null"))
