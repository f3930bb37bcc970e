"""Queries without an SQL twin (forests, tuning, seeded random samplers,
stream scoring, per-batch drift): they run on the small tables and return
rows with the expected columns; models score in a sane range."""

import pytest

import __spark_entry__ as E
from tests.conftest import SMALL

NO_ORACLE = sorted(set(E.queries()) - set(E.oracle_sql()))

EXPECTED = {
    "rf_regression": {"run_id", "params", "metrics", "dataset"},
    "rf_classification": {"accuracy", "roc_auc", "confidence_mean"},
    "tune_random_search": {"trial", "params", "score", "is_best"},
    "batch_score": {"id", "input_features", "prediction_reg", "prediction_class",
                    "prediction_class_proba", "ground_truth"},
    "stream_score": {"flight_uid", "prediction_reg", "prediction_class_proba"},
    "stream_drift_alarm": {"drift_score", "alarm", "batch_id"},
    "drift_alarm": {"drift_score", "alarm", "month"},
}


@pytest.mark.parametrize("name", NO_ORACLE)
def test_rows_only_query_runs(spark, name):
    df = E.queries()[name](spark, SMALL)
    rows = df.collect()
    assert len(rows) > 0
    assert EXPECTED.get(name, set()) <= set(df.columns)
    if name == "rf_classification":
        r = rows[0]
        assert 0.0 <= r["roc_auc"] <= 1.0 and 0.0 <= r["confidence_mean"] <= 1.0
    if name == "tune_random_search":
        assert sum(r["is_best"] for r in rows) == 1 and len(rows) == 3
    if name == "promote_trained_runs":
        runs = sorted(rows, key=lambda r: r["run"])
        best = None
        for r in runs:
            assert r["champion_score"] == best and r["promoted"] == (best is None or r["score"] < best)
            assert r["metric"] == "rmse" and r["score_tag"] == f"{r['score']:.4f}"
            best = r["score"] if best is None else min(best, r["score"])
    if name == "batch_score":
        assert all(0.0 <= r["prediction_class_proba"] <= 1.0 for r in rows)
