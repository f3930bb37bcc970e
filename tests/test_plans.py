"""Plan shape: no row-at-a-time Python UDF anywhere, map-side combine for the
dedup, pushed filters and pruned reads at the scan, streaming == batch."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from skydrift.sources.fixtures import fx_stg
from tests.conftest import SMALL

FAST = ["stg_monthly_delay", "hash_sample", "regression_metrics", "classification_metrics",
        "roc_auc", "delay_rates", "drift_js", "onehot_wide", "frequency_encode",
        "json_expand", "latest_n", "top3_groups", "drift_report", "drift_score_by_month",
        "drift_flow_month", "earliest_n_large", "equalised_samples", "retrain_sample",
        "rolling_std_window", "monitor_batch_metrics"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", FAST)
def test_no_row_python_udf(spark, name):
    plan = _plan(E.queries()[name](spark, SMALL))
    assert "BatchEvalPython" not in plan
    assert "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["earliest_n", "earliest_n_large", "equalised_samples", "retrain_sample"])
def test_no_row_checkpoint(spark, name):
    """The result is a filter on the source, not a read of checkpointed rows."""
    plan = _plan(E.queries()[name](spark, SMALL))
    assert "ExistingRDD" not in plan and "FileScan parquet" in plan


def test_dedup_is_partial_aggregate_not_window(spark):
    plan = _plan(fx_stg(spark, SMALL))
    assert "partial_min" in plan
    assert "Window" not in plan


def test_scan_prunes_and_pushes(spark):
    df = E.queries()["hash_sample"](spark, SMALL)
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(l_extendedprice), GreaterThan(l_extendedprice,0.0)" in plan
    assert "l_comment" not in plan


def test_latest_n_is_take_ordered(spark):
    plan = _plan(E.queries()["latest_n"](spark, SMALL))
    assert "TakeOrderedAndProject" in plan


def test_stream_equals_batch(spark):
    s = E.queries()["stream_tumbling_rates"](spark, SMALL)
    ev = spark.read.parquet(f"{SMALL}/events.parquet")
    b = ev.groupBy(F.date_trunc("day", "ts").alias("d"), "event_type").count()
    got = sorted((r["event_type"], r["n"]) for r in s.collect())
    want = sorted((r["event_type"], r["count"]) for r in b.collect())
    assert got == want


def test_stream_scoring_equals_batch_scoring(spark):
    from pyspark.sql import functions as F
    from skydrift.operators.models import REG_PARAMS, fit_model
    from skydrift.operators.split import chrono_split
    from skydrift.sources.fixtures import calendar_and_targets, fx_raw_from
    from skydrift.sources.tables import read_table
    from skydrift.streaming import jobs as S
    train, _, _ = chrono_split(fx_stg(spark, SMALL), ["flight_date", "flight_uid"])
    reg = fit_model(train, "RandomForestRegressor", REG_PARAMS, "arr_delay_minutes")

    def prep(li):
        raw = fx_raw_from(li)
        return calendar_and_targets(raw.filter((F.col("cancelled") == F.lit(False))
                                               & F.col("origin_airport_id").isNotNull()
                                               & (F.col("distance") > 0)))
    schema = read_table(spark, SMALL, "lineitem").schema
    stream = prep(S.file_stream(spark, SMALL, "lineitem", schema))
    sink = S.run_available(reg.predict(stream).select("flight_uid", "prediction_reg"), "eq")
    got = sorted((r[0], round(r[1], 9)) for r in spark.read.parquet(sink).collect())
    batch = reg.predict(prep(read_table(spark, SMALL, "lineitem")))
    want = sorted((r[0], round(r[1], 9)) for r in batch.select("flight_uid", "prediction_reg")
                  .collect())
    assert got == want
