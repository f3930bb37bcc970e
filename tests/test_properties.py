"""Distributed algorithms against brute force on random small inputs."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skydrift.operators import drift as D
from skydrift.operators import metrics as M
from skydrift.operators.positions import exact_median, running_totals

SETTINGS = dict(max_examples=6, deadline=None)
values = st.lists(st.integers(min_value=-20, max_value=20), min_size=1, max_size=60)


@settings(**SETTINGS)
@given(values)
def test_exact_median_matches_numpy(spark, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "v double")
    assert exact_median(df, "v").first()["median"] == pytest.approx(float(np.median(xs)))


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=2, max_size=50))
def test_auc_matches_pairwise_count(spark, pairs):
    ys = [y for y, _ in pairs]
    if len(set(ys)) < 2:
        return
    df = spark.createDataFrame([(y, float(s)) for y, s in pairs], "y int, s double")
    got = M.roc_auc(df, "y", "s").first()["roc_auc"]
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert got == pytest.approx(want)


@settings(**SETTINGS)
@given(st.lists(st.integers(0, 15), min_size=2, max_size=40),
       st.lists(st.integers(0, 15), min_size=2, max_size=40))
def test_ks_and_wasserstein_match_brute_force(spark, a, b):
    ref = spark.createDataFrame([(float(x),) for x in a], "x double")
    cur = spark.createDataFrame([(float(x),) for x in b], "x double")
    counts = D.value_counts(D.stack_sides(ref, cur, ["x"], []))
    r = D.ordered_stats(D.cumulative_shares(counts)).first()
    grid = np.array(sorted(set(a) | set(b)), dtype=float)
    F = np.array([np.mean(np.array(a) <= g) for g in grid])
    G = np.array([np.mean(np.array(b) <= g) for g in grid])
    assert r["ks_stat"] == pytest.approx(float(np.max(np.abs(F - G))))
    w1 = float(np.sum(np.abs(F - G)[:-1] * np.diff(grid))) if len(grid) > 1 else 0.0
    assert r["w1"] == pytest.approx(w1, abs=1e-9)


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 30)), min_size=1,
                max_size=60, unique=True))
def test_running_totals_match_pandas(spark, rows):
    df = spark.createDataFrame([(g, float(x), float(x % 7)) for g, x in rows],
                               "g string, x double, w double")
    got = {(r["g"], r["x"]): r["cum_w"]
           for r in running_totals(df, ["g"], ["x"], ["w"], partitions=4).collect()}
    pdf = pd.DataFrame([(g, float(x), float(x % 7)) for g, x in rows], columns=["g", "x", "w"])
    pdf = pdf.sort_values(["g", "x"])
    pdf["c"] = pdf.groupby("g")["w"].cumsum()
    for g, x, c in pdf[["g", "x", "c"]].itertuples(index=False):
        assert got[(g, x)] == pytest.approx(c)


def test_frequency_shares_sum_to_one(spark):
    from skydrift.operators.features import frequency_table
    df = spark.range(500).selectExpr("cast(id % 13 as string) as k")
    t = frequency_table(df, "k")
    total = t.frame.groupBy().sum("value").first()[0]
    assert total == pytest.approx(1.0)
    applied = t.lookup(df, "f").groupBy().sum("f").first()[0]
    counts = df.groupBy("k").count().toPandas()["count"]
    assert applied == pytest.approx(float((counts ** 2).sum()) / 500)
