"""Keyed state across micro-batches, and champions that change while a stream runs."""

import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from skydrift.operators import drift as D
from skydrift.operators.features import Preprocessor
from skydrift.operators.models import fit_model, run_row
from skydrift.operators.modelstore import ModelStore
from skydrift.streaming import jobs as S
from skydrift.streaming import state as ST

BEGIN = datetime(2024, 1, 1)


def _grow(spark, rows, schema, folder, files, done=0):
    for k in range(done, files):
        spark.createDataFrame([r for r in rows if r[0] % files == k], schema).coalesce(1).write.mode("append").parquet(folder)
        yield k


def test_newest_std_after_each_batch(spark, tmp_path):
    rng = random.Random(1)
    rows = [(k, rng.choice(["hot"] * 6 + ["b", None]), BEGIN + timedelta(minutes=rng.randint(0, 300)), rng.choice([None, *map(float, range(50))]))
            for k in range(400)]
    schema = "id long, k string, ts timestamp, v double"
    folder, sink, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    for batch in _grow(spark, rows, schema, folder, 4):
        # the stream is started anew for each file: its state goes on
        stream = spark.readStream.schema(schema).parquet(folder)
        with ST.rocksdb_state(spark):
            S.run_available(ST.newest_std(stream, "k", "ts", "id", "v", 30), "newest", "update", S.batch_folder, sink, ckpt)
        got = {r.key: (r.n_rows, r.rolling_std) for r in spark.read.parquet(f"{sink}/batch_id={batch}").collect()}
        for key in ("hot", "b", None):
            newest = sorted((r for r in rows if r[0] % 4 <= batch and r[1] == key), key=lambda r: (r[2], r[0]))[-30:]
            values = [r[3] for r in newest if r[3] is not None]
            assert got[key][0] == len(newest) and got[key][1] == pytest.approx(statistics.stdev(values))


def _flights(n=600):
    rng = random.Random(8)
    return [(k, BEGIN + timedelta(days=(k % 4) * 10 + rng.randint(0, 9)), float(rng.randint(0, 30)) + (k % 4) * 8, rng.choice("xyz")) for k in range(n)]


def _drift_job(spark, folder, sink, ckpt, ref, keep, schema, delay="1 day", fn=None, idle=False):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    with ST.rocksdb_state(spark, idle):
        S.run_available(ST.running_counts(stream, ["v"], ["c"], "ts", keep, delay), "drift", "update", fn or S.drift_running(ref, ["v"], ["c"]), sink, ckpt)


def _alarms(spark, sink):
    return {r.batch_id: (r.n_columns, r.n_drifted, round(r.drift_score, 9), r.alarm) for r in spark.read.parquet(f"{sink}/alarms").collect()}


def test_drift_over_batches_equals_batches(spark, tmp_path):
    rows, schema = _flights(), "id long, ts timestamp, v double, c string"
    ref = spark.createDataFrame([(float(k % 31), "xyz"[k % 3]) for k in range(900)], "v double, c string")
    folder, sink, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    want = {}
    for batch in _grow(spark, rows, schema, folder, 4):
        prefix = spark.createDataFrame([r for r in rows if r[0] % 4 <= batch], schema)
        r = D.with_alarm(D.drift_score(D.drift_report(ref, prefix.select("v", "c"), ["v"], ["c"])), threshold=0.5).first()
        want[batch] = (r.n_columns, r.n_drifted, round(r.drift_score, 9), r.alarm)
        if batch != 1:  # the second and third file come in one run, as two batches
            _drift_job(spark, folder, sink, ckpt, ref, 10_000, schema)
    assert _alarms(spark, sink) == want and len({w[1] for w in want.values()}) > 1

    # a restart in the middle: the third batch fails after its counts are written
    again, ckpt2, calls = str(tmp_path / "out2"), str(tmp_path / "ckpt2"), []

    def fails(batch, epoch, sink):
        calls.append(epoch)
        S.drift_running(ref, ["v"], ["c"])(batch, epoch, sink)
        if epoch == 2 and calls.count(2) == 1:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        _drift_job(spark, folder, again, ckpt2, ref, 10_000, schema, fn=fails)
    _drift_job(spark, folder, again, ckpt2, ref, 10_000, schema, fn=fails)
    assert calls == [0, 1, 2, 2, 3] and _alarms(spark, again) == want


def test_old_days_expire(spark, tmp_path):
    rows, schema = _flights(), "id long, ts timestamp, v double, c string"
    folder, sink, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    ref = spark.createDataFrame([(1.0, "x")], "v double, c string")
    for _ in _grow(spark, rows, schema, folder, 4):
        _drift_job(spark, folder, sink, ckpt, ref, 12, schema, "0 days", idle=True)
    counts = spark.read.parquet(f"{sink}/counts")
    last = counts.groupBy("column", "num", "cat").agg(F.max_by("n_cur", "batch_id").alias("n")).filter("column = 'c'")
    newest = max(r[1] for r in rows)
    got = {r.cat: r.n for r in last.collect()}
    for c in "xyz":  # a day is dropped once the watermark is 12 days past its end
        assert got[c] == sum(r[3] == c and r[1] + timedelta(days=13) > newest for r in rows)


def test_champion_switch_while_a_stream_runs(spark, tmp_path):
    df = spark.range(300).selectExpr("cast(id as string) as flight_uid", "id", "concat('k', id % 4) as k", "id * 1.0 as x",
                                     "cast(id % 9 as double) as arr_delay_minutes", "cast(id % 9 > 4 as int) as arr_del15")
    store = ModelStore(spark, str(tmp_path / "store"))
    versions = {}
    for n, depth in enumerate((1, 3), 1):
        for name, kind, label in (("reg", "RandomForestRegressor", "arr_delay_minutes"), ("cls", "RandomForestClassifier", "arr_del15")):
            m = fit_model(df, kind, {"n_estimators": 2, "max_depth": depth}, label, Preprocessor(low_card_cols=["k"], numeric_cols=["x"], target=label))
            versions[name, n] = store.register(name, m, run_row(spark, m, {}, spark.createDataFrame([(1.0 / n,)], "mae double"), name, {"t": 1}))
    for name in ("reg", "cls"):
        store.promote(versions[name, 1])
    folder, sink, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    names, lost = {"reg": "reg", "cls": "cls"}, []

    def run(fail_at=None):
        inner = S.score_with_champions(store, names)

        def fn(batch, epoch, sink):
            inner(batch, epoch, sink)
            if epoch == fail_at and not lost:
                lost.append(epoch)
                raise RuntimeError("lost")

        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        S.run_available(stream, "champions", "append", fn, sink, ckpt)

    for k in range(4):
        df.filter(F.col("id") % 4 == k).coalesce(1).write.mode("append").parquet(folder)
        if k == 1:
            with pytest.raises(Exception, match="lost"):
                run(fail_at=1)  # scored by the first champions, but its batch was not finished;
            store.promote(versions["reg", 2])  # a promotion comes before the restart
        run()
        if k == 2:
            store.promote(versions["cls", 2])
    log = spark.read.parquet(sink)
    got = {r.batch_id: (r.model_version_reg, r.model_version_class) for r in log.select("batch_id", "model_version_reg", "model_version_class").distinct().collect()}
    assert got == {0: ("reg_v1", "cls_v1"), 1: ("reg_v1", "cls_v1"), 2: ("reg_v2", "cls_v1"), 3: ("reg_v2", "cls_v2")}
    assert log.count() == 300 and log.select("flight_uid").distinct().count() == 300


class _Value:
    """A value state that counts how often it is read and written."""

    def __init__(self):
        self.held, self.calls = None, 0

    def get(self):
        self.calls += 1
        return self.held

    def update(self, value):
        self.calls += 1
        self.held = value

    def clear(self):
        self.held = None


class _Handle:
    def __init__(self):
        self.value, self.timers = _Value(), []

    def getValueState(self, name, schema):
        return self.value

    def registerTimer(self, at):
        self.timers.append(at)


class _Now:
    def __init__(self, now):
        self.now = now

    def getCurrentWatermarkInMs(self):
        return self.now


def test_a_values_state_is_touched_once_however_many_rows_come():
    handle, key = _Handle(), ("v", True, 1.0, None)
    state = ST.DayCounts(2)
    state.init(handle)
    (out,) = state.handleInputRows(key, iter([Row(day=d % 3, n=2) for d in range(900)]), _Now(0))
    assert out.n_cur == 1800.0 and handle.value.calls == 2 and handle.timers == [3 * ST.DAY_MS]
    # day 0 is past what is kept: late rows of it add nothing, and its counts go
    (late,) = state.handleInputRows(key, iter([Row(day=0, n=5)]), _Now(3 * ST.DAY_MS))
    assert late.n_cur == 1800.0
    (left,) = state.handleExpiredTimer(key, _Now(3 * ST.DAY_MS), None)
    assert left.n_cur == 1200.0 and handle.timers[-1] == 4 * ST.DAY_MS
    (none,) = state.handleExpiredTimer(key, _Now(9 * ST.DAY_MS), None)
    assert none.n_cur == 0.0 and handle.value.held is None


def test_partial_counts_meet_across_batches():
    import pyarrow as pa
    names = ["column", "is_num", "num", "cat", "day", "event_ts"]
    batch = pa.RecordBatch.from_arrays([pa.array(["v", "v", "c"]), pa.array([True, True, False]), pa.array([1.0, 1.0, None]),
                                        pa.array([None, None, "x"], pa.string()), pa.array([3, 3, 4], pa.int32()),
                                        pa.array([1, 2, 3], pa.timestamp("us", "UTC"))], names)
    rows = [r for b in ST._partial_counts([batch] * 5) for r in b.to_pylist()]
    assert sorted((r["column"], r["day"], r["n"], r["event_ts"].microsecond) for r in rows) == [("c", 4, 5, 3), ("v", 3, 10, 2)]


def test_a_buckets_state_is_touched_once_however_many_values_come():
    import pandas as pd

    handle, key = _Handle(), ("v", True, 5)
    state = ST.BucketCounts(2)
    state.init(handle)
    nan = float("nan")
    rows = pd.DataFrame({"num": [float(k % 50) for k in range(900)] + [nan, nan], "cat": None, "day": [k % 3 for k in range(900)] + [1, 1], "n": 2})

    def got(frames):
        (frame,) = frames
        assert list(frame.columns) == ["column", "is_num", "num", "cat", "n_cur"]
        return {repr(r.num): r.n_cur for r in frame.itertuples()}

    first = got(state.handleInputRows(key, iter([rows[:500], rows[500:]]), _Now(0)))
    assert first == {**{repr(float(v)): 36.0 for v in range(50)}, "nan": 4.0}
    assert handle.value.calls == 2 and handle.timers == [3 * ST.DAY_MS]
    # day 0 is past what is kept: late rows of it add nothing, and its counts go
    late = pd.DataFrame({"num": [7.0, 99.0], "cat": None, "day": 0, "n": 5})
    assert got(state.handleInputRows(key, iter([late]), _Now(3 * ST.DAY_MS))) == {"7.0": 36.0, "99.0": 0.0}
    left = got(state.handleExpiredTimer(key, _Now(3 * ST.DAY_MS), None))
    assert left == {repr(float(v)): 24.0 for v in range(50)} and handle.timers[-1] == 4 * ST.DAY_MS
    none = got(state.handleExpiredTimer(key, _Now(9 * ST.DAY_MS), None))
    assert set(none.values()) == {0.0} and len(none) == 51 and handle.value.held is None
    text, key = ST.BucketCounts(2), ("c", False, 5)
    text.init(_Handle())
    (frame,) = text.handleInputRows(key, iter([pd.DataFrame({"num": nan, "cat": ["x", "y", "x"], "day": [1, 1, 2], "n": 1})]), _Now(0))
    assert sorted(zip(frame.cat, frame.n_cur)) == [("x", 2.0), ("y", 1.0)] and frame.num.isna().all()
