"""What model queries leave on disk and hold in memory while they run."""

import os
import time

import pytest
from pyspark.sql import functions as F

from skydrift.operators.features import Preprocessor
from skydrift.operators.models import evaluate, fit_model, predict_together
from skydrift.operators.tuning import search
from skydrift.plans import stream_queries
from skydrift.session import scratch_path, temporaries, written
from skydrift.streaming import jobs as S


@pytest.fixture(scope="module")
def flights(spark):
    return spark.range(400).selectExpr(
        "cast(id as string) as flight_uid", "if(id % 7 = 0, null, concat('k', id % 5)) as k", "if(id % 11 = 0, null, id % 30) as place", "id % 4 as low",
        "id * 1.0 as x", "cast(id % 9 as double) as late", "cast(id % 9 > 4 as int) as arr_del15")


def _models(flights):
    def prep(y):
        return Preprocessor(low_card_cols=["low"], high_card_cols=["k", "place"], numeric_cols=["x"], target=y, fold_key="flight_uid")

    return (fit_model(flights, "RandomForestRegressor", {"n_estimators": 3, "max_depth": 3}, "late", prep("late")),
            fit_model(flights.filter("place is null or place < 20"), "RandomForestClassifier",
                      {"n_estimators": 3, "max_depth": 2, "class_weight": "balanced"}, "arr_del15", prep("arr_del15")))


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}


def test_written_frames_leave_no_shuffle(spark):
    before, key = _shuffle_files(spark), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    had = spark.conf.get(key, None)
    rows = written(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count().orderBy("count", "k"), "few")
    for _ in range(50):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left and rows.count() == 100 and spark.conf.get(key, None) == had
    assert all(f.endswith(".zstd.parquet") for f in map(os.path.basename, rows.inputFiles()))


def test_two_models_look_up_together(flights):
    reg, cls = _models(flights)
    odd = flights.unionByName(flights.limit(3).withColumns({"flight_uid": F.lit("new"), "k": F.lit("unseen"), "place": F.lit(77).cast("long")}))
    want, got = cls.predict(reg.predict(odd)), predict_together(odd, reg, cls)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    joins = [df._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") for df in (want, got)]
    assert joins == [4, 2]


def test_trees_grow_from_files(spark, flights, monkeypatch):
    def held(self, *args):
        raise AssertionError("held in memory")

    monkeypatch.setattr(type(flights), "persist", held)
    top = os.path.dirname(scratch_path(spark, "x")).removeprefix("file:")
    before = set(os.listdir(top))
    reg, cls = _models(flights)
    assert set(os.listdir(top)) == before  # the feature files are gone
    with temporaries(spark):
        assert evaluate(reg, flights, "arr_del15").first().rmse > 0 and evaluate(cls, flights).first().n == 400
    log = search(spark, flights, flights, "RandomForestRegressor", "late", {"max_depth": ("int", 1, 2)}, {"n_estimators": 2}, 2, "rmse",
                 prep=Preprocessor(low_card_cols=["low"], numeric_cols=["x"]))
    assert log.count() == 2 and set(os.listdir(top)) == before


def test_stream_sinks_and_requests_are_compressed(spark, flights, monkeypatch, tmp_path):
    flights.write.parquet(str(tmp_path / "in"))
    sink = S.run_available(spark.readStream.schema(flights.schema).parquet(str(tmp_path / "in")), "small")
    assert all(".zstd." in f for f in os.listdir(sink.removeprefix("file:")) if f.startswith("part-"))

    class Asked(Exception):
        pass

    class Store:
        def champions(self, names):
            return {role: (None, None) for role in names}

    def asked(spark, folder):
        raise Asked(folder)

    monkeypatch.setattr(stream_queries, "stored_champions", lambda *a: Store())
    monkeypatch.setattr(stream_queries.S, "text_stream", asked)
    li = spark.range(50).selectExpr(
        "id as l_orderkey", "id % 5 as l_partkey", "id % 3 + 1 as l_suppkey", "1 as l_linenumber", "if(id % 4 = 0, 7.0D, id * 1.0D) as l_quantity",
        "id * 100.0D + 1 as l_extendedprice", "0.05D as l_discount", "0.02D as l_tax", "'R' as l_returnflag", "'F' as l_linestatus",
        "cast('1999-05-05' as timestamp_ntz) as l_shipdate")
    li.write.parquet(str(tmp_path / "lineitem.parquet"))
    with pytest.raises(Asked) as found:
        stream_queries.q_stream_score_requests(spark, str(tmp_path))
    folder = str(found.value).removeprefix("file:")
    parts = [f for f in os.listdir(folder) if f.startswith("part-")]
    assert parts and all(f.endswith(".txt.gz") for f in parts)
    lines = [r.value for r in spark.read.text(folder).collect()]
    assert len(lines) == 50 and sum(not x.endswith("}") for x in lines) == 14  # elapsed times of 7 are none
