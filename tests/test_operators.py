"""Hand-computed micro cases and properties of the operators."""

import pytest
from pyspark.sql import functions as F

from skydrift.functions.exprs import text_to_bool, text_to_int_rounded
from skydrift.operators import drift as D
from skydrift.operators import metrics as M
from skydrift.operators.features import Preprocessor, frequency_table
from skydrift.operators.positions import exact_median, global_row_number, running_totals
from skydrift.operators.split import chrono_split_labels
from skydrift.operators.staging import dedup_keep_first, quality_filter, stage_flights
from skydrift.schemas import raw_typed_schema


# ----------------------------------------------------------------- encoders
def test_frequency_encoding_is_the_share_of_rows(spark):
    train = spark.createDataFrame([(c,) for c in "pqqrrrrssss"], "x string")
    t = frequency_table(train, "x")
    probe = spark.createDataFrame([("p",), ("q",), ("r",), ("s",), ("t",)], "x string")
    got = {r["x"]: r["f"] for r in t.lookup(probe, "f").collect()}
    assert got == {c: pytest.approx("pqqrrrrssss".count(c) / 11) for c in "pqrst"}


def test_onehot_unknown_category_and_scaling(spark):
    train = spark.createDataFrame([("north", 2), ("south", 4), ("south", 4), ("west", 10)],
                                  "gate string, wait int")
    test = spark.createDataFrame([("east", 9), ("south", 5)], "gate string, wait int")
    fit = Preprocessor(low_card_cols=["gate"], numeric_cols=["wait"]).fit(train)
    unseen, seen = (r["features"].toArray().tolist() for r in fit.transform(test).orderBy("gate").collect())
    # mean 5, population std 3: (9 - 5) / 3 and (5 - 5) / 3
    assert unseen == pytest.approx([0.0, 0.0, 0.0, 4 / 3])
    assert seen == pytest.approx([0.0, 1.0, 0.0, 0.0])


def test_unknown_strategy_raises():
    with pytest.raises(ValueError):
        Preprocessor(low_card_strategy="hash")
    with pytest.raises(ValueError):
        Preprocessor(high_card_strategy="embedding")


# ----------------------------------------------------------------- ingest / staging
def test_text_casts(spark):
    df = spark.createDataFrame([("12.0", "True"), ("2.5", "False"), ("-2.5", "true"),
                                ("", None)], "n string, b string")
    out = df.select(text_to_int_rounded("n").alias("n"), text_to_bool("b").alias("b")).collect()
    assert [r["n"] for r in out] == [12, 3, -3, None]
    assert [r["b"] for r in out] == [True, False, None, None]


def test_quality_filter_null_flag_drops(spark):
    df = spark.createDataFrame([(False, 1.0), (None, 1.0), (True, 1.0), (False, 0.0)],
                               "c boolean, d double")
    assert quality_filter(df, ["c"], [], ["d"]).count() == 1


def test_dedup_ties_and_nulls(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", "B", 2), ("k", "A", 3), ("k", "A", 0),
                                ("j", None, 5)], "k string, airline string, tie int")
    out = {r["k"]: (r["airline"], r["tie"])
           for r in dedup_keep_first(df, "k", ["airline", "tie"]).collect()}
    assert out == {"k": ("A", 0), "j": (None, 5)}


def test_stage_flights_end_to_end(spark):
    row = {n: None for n in raw_typed_schema().names}
    import datetime as dt
    base = dict(row, Year=2019, Month=1, FlightDate=dt.date(2019, 1, 5), Origin="JFK",
                Dest="LAX", Operating_Airline="AA", CRSDepTime=900, ArrDelay=3.0,
                ArrDelayMinutes=3.0, ArrDel15=0.0, Distance=2475, Cancelled=False,
                Diverted=False, Marketing_Airline_Network="B")
    dup = dict(base, Marketing_Airline_Network="A", Tail_Number="N1")
    cancelled = dict(base, Cancelled=True, CRSDepTime=1000)
    df = spark.createDataFrame([base, dup, cancelled], raw_typed_schema())
    out = stage_flights(df).collect()
    assert len(out) == 1
    assert out[0]["flight_uid"] == "JFK_LAX_2019-01-05_AA_900"
    assert out[0]["marketing_airline_network"] == "A"
    assert len(out[0]) == 30


# ----------------------------------------------------------------- positions / split
@pytest.mark.parametrize("n", [0, 1, 7, 20])
def test_chrono_split_sizes(spark, n):
    df = spark.range(n).select(F.col("id").cast("string").alias("k"),
                               (F.col("id") % 3).alias("d"))
    lab = chrono_split_labels(df, ["d", "k"])
    sizes = {r["part"]: r["count"] for r in lab.groupBy("part").count().collect()}
    assert sizes.get("train", 0) == int(n * 0.7)
    assert sizes.get("val", 0) == int(n * 0.85) - int(n * 0.7)
    assert sum(sizes.values()) == n
    pos = sorted(r["pos"] for r in lab.select("pos").collect())
    assert pos == list(range(n))


def test_global_row_number_matches_sort(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("v"))
    got = [r["v"] for r in global_row_number(df, ["v"], "p").orderBy("p").collect()]
    assert got == sorted(got) and len(got) == 5000


def test_running_totals_hot_group(spark):
    # one group holds most rows: range partitioning still splits it
    df = spark.range(3000).select(F.when(F.col("id") < 2500, "hot").otherwise("cold").alias("g"),
                                  F.col("id").cast("double").alias("x"), F.lit(1.0).alias("one"))
    out = running_totals(df, ["g"], ["x"], ["one"], partitions=8).collect()
    hot = sorted((r["x"], r["cum_one"]) for r in out if r["g"] == "hot")
    assert [c for _, c in hot] == [float(i + 1) for i in range(2500)]


def test_exact_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (10.0,)], "v double")
    assert exact_median(df, "v").first()["median"] == 2.0
    df2 = spark.createDataFrame([(1.0,), (3.0,), (4.0,), (10.0,)], "v double")
    assert exact_median(df2, "v").first()["median"] == 3.5


# ----------------------------------------------------------------- metrics
def test_zero_denominators_and_guard(spark):
    one_class = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    r = M.classification_metrics(one_class, "y", "p").first()
    assert r["precision"] == 0.0 and r["f1"] == 0.0 and r["accuracy"] == 0.0
    no_pos_pred = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int")
    r = M.classification_metrics(no_pos_pred, "y", "p").first()
    assert r["precision"] == 0.0 and r["recall"] == 0.0 and r["accuracy"] == 0.5


def test_auc_symmetry_and_ties(spark):
    df = spark.range(200).select((F.col("id") % 2).cast("int").alias("y"),
                                 ((F.col("id") * 37) % 11).cast("double").alias("s"))
    a = M.roc_auc(df, "y", "s").first()["roc_auc"]
    b = M.roc_auc(df.withColumn("s", -F.col("s")), "y", "s").first()["roc_auc"]
    assert a + b == pytest.approx(1.0)
    ties = spark.createDataFrame([(1, 0.5), (0, 0.5)], "y int, s double")
    assert M.roc_auc(ties, "y", "s").first()["roc_auc"] == 0.5


def test_regression_metrics_known_values(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 5.0)], "y double, p double")
    r = M.regression_metrics(df, "y", "p").first()
    assert r["mae"] == pytest.approx(1.0)
    assert r["mse"] == pytest.approx(5 / 3)
    assert r["medae"] == pytest.approx(1.0)
    assert r["r2"] == pytest.approx(1 - 5 / 2)


# ----------------------------------------------------------------- drift properties
def _frame(spark):
    return spark.range(3000).select(
        (F.col("id") % 97).cast("double").alias("a"),
        F.when(F.col("id") % 3 == 0, "x").when(F.col("id") % 3 == 1, "y").otherwise("z")
         .alias("c"))


def test_drift_of_identical_frames_is_zero(spark):
    df = _frame(spark)
    score = D.drift_score(D.drift_report(df, df, ["a"], ["c"])).first()
    assert score["drift_score"] == 0.0


def test_booster_raises_drift(spark):
    df = _frame(spark)
    base = D.drift_score(D.drift_report(df, df, ["a"], ["c"])).first()["drift_score"]
    boosted = D.drift_score(D.drift_report(df, D.boost(df, ["a"], ["c"]), ["a"], ["c"])) \
        .first()["drift_score"]
    assert boosted > base and boosted == 1.0


def test_small_reference_uses_tests(spark):
    df = spark.range(300).select((F.col("id") % 50).cast("double").alias("a"),
                                 (F.col("id") % 2).cast("string").alias("b"),
                                 (F.col("id") % 4).cast("string").alias("c"))
    rep = {r["column"]: r for r in D.drift_report(df, df, ["a"], ["b", "c"]).collect()}
    assert rep["a"]["test"] == "ks" and rep["b"]["test"] == "z"
    assert rep["c"]["test"] == "chisquare"
    assert all(not r["drifted"] for r in rep.values())
    assert rep["a"]["p_value"] == pytest.approx(1.0)


# ----------------------------------------------------------------- lifecycle
def test_write_counted_and_load_once(spark):
    from skydrift.operators import lifecycle as L
    from skydrift.session import scratch_path
    path = scratch_path(spark, "t")
    df = spark.range(10).toDF("id")
    assert L.write_counted(df, path) == 10
    t, n = L.load_once(spark, path, lambda: spark.range(99).toDF("id"))
    assert n is None and t.count() == 10
    fresh = scratch_path(spark, "u")
    t, n = L.load_once(spark, fresh, lambda: spark.range(4).toDF("id"))
    assert n == 4


def test_promotion_is_strict(spark):
    from skydrift.operators.lifecycle import promotion_decisions
    runs = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 4.0), (4, 4.5)], "t int, rmse double")
    got = [r["promoted"] for r in promotion_decisions(runs, "rmse", ["t"]).orderBy("t").collect()]
    assert got == [True, False, True, False]


def test_score_selection_and_model_factory():
    from skydrift.operators.metrics import select_score
    from skydrift.operators.models import create_model
    assert select_score({"rmse": 2.0, "mae": 1.0}, {"promotion_metric": "mae"}, "rmse") == \
        ("mae", 1.0)
    assert select_score({"rmse": 2.0}, {}, "rmse") == ("rmse", 2.0)
    with pytest.raises(ValueError):
        select_score({"rmse": 2.0}, {"tuning_metric": "nope"}, "rmse")
    with pytest.raises(ValueError):
        create_model("GradientBoostedTrees", {}, "y")


def test_empty_batch_metrics_are_zero(spark):
    empty = spark.createDataFrame([], "y double, p double")
    r = M.guarded(M.regression_metrics(empty, "y", "p", with_median=False),
                  ["mae", "mse", "rmse", "r2", "residual_skewness"]).first()
    assert r["n"] == 0 and r["mae"] == 0.0 and r["rmse"] == 0.0 and r["r2"] == 0.0


def test_cached_reference_counts_equal_direct_report(spark):
    ref = _frame(spark)
    cur = D.boost(_frame(spark).filter("a < 50"), ["a"], [])
    direct = {r["column"]: r["statistic"] for r in D.drift_report(ref, cur, ["a"], ["c"]).collect()}
    counts = D.merge_counts(D.side_counts(ref, "reference", ["a"], ["c"]),
                            D.side_counts(cur, "current", ["a"], ["c"]))
    via = {r["column"]: r["statistic"] for r in D.report_from_counts(counts).collect()}
    assert direct.keys() == via.keys()
    for k in direct:
        assert direct[k] == pytest.approx(via[k])


def test_small_integers_are_kept_first_with_nulls_last(spark):
    rows = [("a", None, 1, "x"), ("a", 2147483647, None, "y"), ("a", 2147483647, 7, "z"), ("b", None, None, "x"), ("b", None, 3, None),
            ("c", -2147483648, None, "y"), ("c", 0, 1, "x"), ("d", None, None, None)]
    df = spark.createDataFrame(rows, "k string, i int, j smallint, s string")
    first = dedup_keep_first(df, "k", ["i", "j", "s"])
    assert first.dtypes == df.dtypes
    assert {tuple(r) for r in first.collect()} == {("a", 2147483647, 7, "z"), ("b", None, 3, None), ("c", -2147483648, None, "y"), ("d", None, None, None)}


def test_staging_shuffles_no_null_flag_that_it_can_spare(spark):
    import re
    spark.conf.set("spark.sql.debug.maxToStringFields", "500")
    df = spark.createDataFrame([], raw_typed_schema())
    plan = stage_flights(df)._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    flags = {int(x) for x in re.findall(r"\b_n(\d+)\b", plan)}
    assert flags and len(flags) <= 9 and max(int(x) for x in re.findall(r"\b_o(\d+)\b", plan)) == 28


@pytest.mark.parametrize("name", ["json_typed_discovery", "json_expand_typed", "feature_assembly"])
def test_staging_rows_are_computed_once(spark, tmp_path, name):
    from skydrift.plans import catalog
    spark.range(400).selectExpr(
        "id as l_orderkey", "id * 7 % 90 as l_partkey", "id % 20 as l_suppkey", "cast(id % 4 as int) as l_linenumber",
        "cast(id % 50 as double) as l_quantity", "cast(1000 + id * 37 as double) as l_extendedprice", "id % 11 / 100D as l_discount",
        "0.02D as l_tax", "substr('ANR', cast(id % 3 as int) + 1, 1) as l_returnflag", "substr('OF', cast(id % 2 as int) + 1, 1) as l_linestatus",
        "cast(date_add(date'1997-01-01', cast(id * 3 as int)) as timestamp_ntz) as l_shipdate") \
        .write.parquet(str(tmp_path / "lineitem.parquet"))
    out = catalog.QUERIES[name](spark, str(tmp_path))
    assert out.count() > 5 and not [x for x in out.inputFiles() if "lineitem" in x]
