"""Stored models, versions and champions; batch tables under one manifest."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from skydrift.operators import batches as B
from skydrift.operators import manifest as MF
from skydrift.operators.features import Preprocessor
from skydrift.operators.models import fit_model, run_row
from skydrift.operators.modelstore import ModelStore
from skydrift.operators.pipeline import FlightEncoder, FlightEncoderModel, load_model, save_model

COLUMNS = dict(low_card_cols=["k"], high_card_cols=["who", "num"], cyclic_cols=["hhmm"], numeric_cols=["x"],
               skewed_numeric_cols=["far"], target="y", fold_key="id")


@pytest.fixture(scope="module")
def flights(spark):
    df = spark.range(600).selectExpr(
        "cast(id as string) as id", "concat('k', id % 4) as k", "if(id % 17 = 0, null, concat('w', id % 23)) as who", "id % 7 as num",
        "(id % 24) * 100 + id % 60 as hhmm", "if(id % 11 = 0, null, id % 13 + 0.5) as x", "id * 3.0 as far",
        "cast((id % 5) * 4 + (id % 3) as double) as y", "cast(id % 5 > 2 as int) as late")
    return df.repartition(3)


@pytest.fixture(scope="module")
def models(flights):
    reg = fit_model(flights, "RandomForestRegressor", {"n_estimators": 4, "max_depth": 4, "random_state": 1}, "y", Preprocessor(**COLUMNS))
    cls = fit_model(flights, "RandomForestClassifier", {"n_estimators": 4, "max_depth": 3, "random_state": 1}, "late",
                    Preprocessor(**{**COLUMNS, "target": "late", "high_card_strategy": "frequency", "low_card_strategy": "sparse"}))
    return reg, cls


def _unseen(flights):
    return flights.withColumn("k", F.when(F.col("num") == 3, "new").otherwise(F.col("k"))) \
        .withColumn("who", F.when(F.col("num") == 4, "stranger").otherwise(F.col("who")))


def test_loaded_model_predicts_the_same_in_a_new_session(spark, flights, models, tmp_path):
    df = _unseen(flights)
    want = {}
    for n, model in enumerate(models):
        save_model(model, str(tmp_path / f"m{n}"))
        want[n] = sorted(map(repr, model.predict(df).collect()))
        assert sorted(map(repr, load_model(spark, str(tmp_path / f"m{n}")).predict(df).collect())) == want[n]
    df.write.parquet(str(tmp_path / "rows"))
    code = """
import sys, json
from skydrift.session import build_session
from skydrift.operators.pipeline import load_model
spark = build_session("local[2]", shuffle_partitions=2)
rows = spark.read.parquet(sys.argv[1] + "/rows")
print(json.dumps([sorted(map(repr, load_model(spark, f"{sys.argv[1]}/m{n}").predict(rows).collect())) for n in range(2)]))
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code, str(tmp_path)], capture_output=True, text=True, cwd=root, timeout=300,
                          env={**os.environ, "PYTHONPATH": root})
    assert json.loads(done.stdout.splitlines()[-1]) == [want[0], want[1]], done.stderr[-2000:]


def test_encoder_is_a_stage(spark, flights, tmp_path):
    encoder = FlightEncoder.of(Preprocessor(**COLUMNS))
    encoder.save(str(tmp_path / "e"))
    assert FlightEncoder.load(str(tmp_path / "e")).preprocessor() == Preprocessor(**COLUMNS)
    model = encoder.fit(flights)
    model.save(str(tmp_path / "m"))
    again = FlightEncoderModel.load(str(tmp_path / "m"))
    assert again.uid == model.uid
    a, b = (sorted(map(repr, m.transform(_unseen(flights)).select("id", "features").collect())) for m in (model, again))
    assert a == b
    assert model.transform_training(flights).count() == 600


def test_sparse_onehot_of_many_levels(spark):
    n = 100_000
    df = spark.range(n).select(F.concat(F.lit("v"), "id").alias("c"), (F.col("id") % 3).alias("z"), F.lit(1.0).alias("y"))
    fitted = Preprocessor(low_card_cols=["c", "z"], low_card_strategy="sparse").fit(df)
    assert not fitted.onehot_levels  # no level reaches the driver
    some = spark.createDataFrame([("v7", 1), ("never", 2), (None, None), ("v99999", 9)], "c string, z long")
    fitted.cat_fill = {}  # so that NULL stays NULL
    out = fitted.transform(some)
    assert len(out.columns) == 5 and len(out._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    got = {r.c: r.features for r in out.collect()}
    assert all(v.size == n + 3 for v in got.values())
    levels = sorted(f"v{k}" for k in range(n))
    assert got["v7"].indices.tolist() == [levels.index("v7"), n + 1] and got["v7"].values.tolist() == [1.0, 1.0]
    assert got["never"].indices.tolist() == [n + 2] and got[None].numNonzeros() == 0
    assert got["v99999"].indices.tolist() == [levels.index("v99999")]


def test_sparse_equals_plain_onehot(flights):
    plain, sparse = (Preprocessor(low_card_cols=["k", "num"], low_card_strategy=s).fit(flights) for s in ("onehot", "sparse"))
    a, b = ({r.id: r.features.toArray().tolist() for r in p.transform(_unseen(flights)).collect()} for p in (plain, sparse))
    assert a == b


def _run(spark, model, rmse):
    return run_row(spark, model, {"d": 1}, spark.createDataFrame([(rmse,)], "rmse double"), "delay", {"name": "t"})


def test_store(spark, models, tmp_path):
    store = ModelStore(spark, str(tmp_path))
    assert store.champion("delay") is None and store.runs().count() == 0 and store.pointer() == -1
    reg, cls = models
    first = store.register("delay", reg, _run(spark, reg, 5.0))
    assert store.register("delay", reg, _run(spark, reg, 5.0)) == first  # a retry
    assert store.promote_if_better(first, "rmse")
    before = store.pointer()
    cls_v = store.register("delay", cls, _run(spark, cls, 6.0))
    assert cls_v.label == "delay_v2" and not store.promote_if_better(cls_v, "rmse")
    assert store.promote_if_better(cls_v, "rmse", "maximize") and store.champion("delay").number == 2
    assert store.champion("delay", before).number == 1  # as of an earlier state
    with pytest.raises(LookupError):
        store.champions({"a": "delay", "b": "other"})
    with pytest.raises(ValueError):
        store.promote_if_better(first, "rmse", "best")
    got = [(r.version, r.champion) for r in ModelStore(spark, str(tmp_path)).versions().orderBy("version").collect()]
    assert got == [(1, False), (2, True)]
    assert {(r.run_id, r.metrics["rmse"]) for r in store.runs().collect()} == {(reg.run_id, 5.0), (cls.run_id, 6.0)}


def test_manifest_conflict(spark, tmp_path):
    m = MF.Manifest(spark, str(tmp_path / "m"))
    assert m.read() == (-1, {})
    assert m.commit(-1, {"a": 1}) == 0
    with pytest.raises(MF.Conflict):
        m.commit(-1, {"a": 2})
    assert m.read() == (0, {"a": 1})
    other = MF.Manifest(spark, str(tmp_path / "m"))
    raced = []

    def change(document):  # another commit comes between the first read and the commit
        if not raced:
            raced.append(other.commit(0, {"a": 7}))
        return {"a": document["a"] + 1}

    assert m.update(change) == (2, {"a": 8}) and m.at(1) == {"a": 7}


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", ["before write", "after write", "before commit", "aside written", "after commit", None])
def test_append_and_clear_are_one_commit(spark, tmp_path, monkeypatch, step):
    tables = B.BatchTables(spark, str(tmp_path / "t"))
    log = spark.range(30).selectExpr("id", "cast(id % 3 as int) as batch", "id * 2.0 as x")
    assert tables.create("log", log.drop("batch").schema) and not tables.create("log", log.schema)
    tables.create("retrain", log.select("id").schema)
    for b in range(3):
        assert tables.append(log.filter(F.col("batch") == b).drop("batch"), "log", b)
    assert not tables.append(log.drop("batch"), "log", 1)
    with monkeypatch.context() as m:
        write, update, commit = B.BatchTables.write, MF.Manifest.update, MF.Manifest.commit
        if step == "before write":
            m.setattr(B.BatchTables, "write", lambda *a: (_ for _ in ()).throw(Crash()))
        if step == "after write":
            m.setattr(B.BatchTables, "write", lambda *a: (write(*a), (_ for _ in ()).throw(Crash())))
        if step == "before commit":
            m.setattr(MF.Manifest, "update", lambda *a: (_ for _ in ()).throw(Crash()))
        if step == "aside written":
            def half(self, after, document):
                commit(MF.Manifest(spark, self.folder + "-aside"), -1, document)
                raise Crash
            m.setattr(MF.Manifest, "commit", half)
        if step == "after commit":
            m.setattr(MF.Manifest, "update", lambda *a: (update(*a), (_ for _ in ()).throw(Crash())))
        if step:
            with pytest.raises(Crash):
                tables.move("log", [0, 1], "retrain", 0, lambda df: df.select("id"))
    # at any time each row is in exactly one of the tables
    both = [r.id for t in ("log", "retrain") for r in tables.read(t).collect()]
    assert sorted(both) == list(range(30))
    assert tables.append(spark.createDataFrame([(99, 1.0)], "id long, x double"), "log", 3)  # arrives meanwhile
    done = tables.move("log", [0, 1], "retrain", 0, lambda df: df.select("id"))
    assert done == (step != "after commit")
    assert not tables.move("log", [0, 1], "retrain", 0, lambda df: df.select("id"))
    assert sorted(r.id for r in tables.read("retrain").collect()) == [i for i in range(30) if i % 3 < 2]
    assert sorted(r.id for r in tables.read("log").collect()) == [*range(2, 30, 3), 99] and tables.batches("log") == [2, 3]
    with pytest.raises(ValueError):
        tables.move("log", [2, 2], "retrain", 1, lambda df: df.select("id"))
    assert tables.read("log").count() == 11
    files = tables.read("log").inputFiles()
    assert tables.vacuum() >= 2 and tables.read("log").inputFiles() == files  # the rows that stay are not moved
    assert not tables.append(log.drop("batch"), "log", 0)  # consumed: not appended once more
