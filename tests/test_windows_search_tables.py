"""Halo windows, date cuts, adaptive search, typed JSON discovery, buckets."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from skydrift.functions.json import discover_types, object_types
from skydrift.operators import catalogue as C
from skydrift.operators import tuning as TU
from skydrift.operators.monitor import rolling_std_window
from skydrift.operators.positions import rows_at
from skydrift.operators.scoring import expand_variant


@pytest.mark.parametrize("partitions", [1, 7, 60])
def test_rolling_std_by_halo(spark, partitions):
    rng = random.Random(2)
    rows = [(rng.choice(["hot"] * 5 + ["a", None, "b"]), k, rng.choice([None, *map(float, range(1, 40))])) for k in range(700)]
    df = spark.createDataFrame(rows, "k string, t long, v double")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted(((r.k, r.t, r.v, r.rolling_std) for r in rolling_std_window(df, "v", ["k"], ["t"], 20).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == len(rows)
    for k, t, v, std in got:
        last = [x for key, at, x in sorted((r for r in rows if r[0] == k and r[1] <= t), key=lambda r: r[1])[-20:] if x is not None]
        if len(last) < 2:
            assert std is None
        else:
            assert std == pytest.approx(statistics.stdev(last), abs=1e-9)


def test_halo_plan(spark):
    df = spark.range(500).selectExpr("id % 3 as k", "id as t", "id * 1.0 as v")
    plan = rolling_std_window(df, "v", ["k"], ["t"], 10)._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan
    assert plan.split("== Physical Plan ==")[1].count("Join") == 1  # with a row per range, not with itself


def test_rows_at_dates(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, "2020-01-01", "2020-01-02", "2020-03-01", "2020-01-02"]), k) for k in range(300)]
    df = spark.createDataFrame(rows, "d string, k long").selectExpr("cast(d as date) as d", "k")
    order = sorted(((r.d, r.k) for r in df.collect()), key=lambda r: (r[0] is not None, r[0], r[1]) if r[0] else (False, r[1], 0))
    wanted = [0, 1, 50, 51, 133, 299, 300, 1000]
    assert rows_at(df, ["d", "k"], wanted) == {p: order[p] for p in wanted if p < 300}
    assert rows_at(df.filter("1 = 0"), ["d", "k"], [0, 5]) == {}


def _branin(p):
    x, y = p["x"], p["y"]
    return (y - 5.1 / (4 * math.pi ** 2) * x * x + 5 / math.pi * x - 6) ** 2 + 10 * (1 - 1 / (8 * math.pi)) * math.cos(x) + 10


FUNCTIONS = [
    (_branin, {"x": ("float", -5.0, 10.0), "y": ("float", 0.0, 15.0)}),
    (lambda p: (math.log10(p["rate"]) + 3) ** 2 + (p["depth"] - 7) ** 2 / 10, {"rate": ("logfloat", 1e-6, 1.0), "depth": ("int", 1, 30)}),
    (lambda p: sum((p[c] - k) ** 2 for k, c in enumerate("abcd")), {c: ("float", -10.0, 10.0) for c in "abcd"}),
]


@pytest.mark.parametrize("number", range(len(FUNCTIONS)))
def test_tpe_beats_random(number):
    f, space = FUNCTIONS[number]
    best = {s: [min(score for _, score in TU.optimise(f, space, {"fixed": 1}, 60, seed=seed, sampler=s)) for seed in range(15)]
            for s in ("tpe", "random")}
    assert statistics.median(best["tpe"]) < 0.7 * statistics.median(best["random"]) or statistics.median(best["tpe"]) < 0.45
    assert sum(a < b for a, b in zip(best["tpe"], best["random"])) >= 10


def test_search_options():
    space = {"n": ("int", 2, 4), "x": ("logfloat", 0.1, 10.0), "one": ("int", 5, 5)}
    a, b = (TU.optimise(lambda p: p["n"], space, {"z": 9}, 30, "maximize", seed=4) for _ in range(2))
    assert a == b and {p["n"] for p, _ in a} <= {2, 3, 4} and all(p["z"] == 9 and p["one"] == 5 and 0.1 <= p["x"] <= 10 for p, _ in a)
    assert sum(p["n"] == 4 for p, _ in a[15:]) > 10
    history = [({k: v for k, v in p.items() if k != "z"}, -s) for p, s in a[:20]]
    assert TU.TpeSampler(space, 4).ask(history) == {k: v for k, v in a[20][0].items() if k != "z"}  # continued, not begun anew
    assert len(TU.optimise(lambda p: math.nan, space, {}, 12)) == 12
    for bad in ({"a": ("text", 0, 1)}, {"a": ("float", 2, 1)}, {"a": ("logfloat", 0, 1)}):
        with pytest.raises(ValueError):
            TU.optimise(lambda p: 0, bad, {}, 1)
    with pytest.raises(ValueError):
        TU.optimise(lambda p: 0, space, {}, 1, sampler="grid")
    with pytest.raises(ValueError):
        TU.optimise(lambda p: 0, space, {}, 1, direction="best")


def test_typed_discovery(spark):
    docs = ['{"n": 1, "x": 1.5, "s": "a", "b": true, "o": {"y": [1, 2]}, "it\'s": 3, "\'\\"": 4, "a.b": "p", "m": 1}', '{"n": 2, "x": 3, "z": null, "m": "two"}',
            "{broken", None, "[1, 2]", '{"n": null, "big": 12345678901234567890}']
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, j string")
    assert discover_types(df.filter("i in (0, 1, 5)"), "j") == {
        "n": "bigint", "x": "double", "s": "string", "b": "boolean", "o": "string", "it's": "bigint", "'\"": "bigint", "a.b": "string",
        "m": "string", "z": "string", "big": "double"}
    got = {r.i: r for r in expand_variant(df, "j", ["i"], discover_types(df.filter("i in (0, 1, 5)"), "j")).collect()}
    assert (got[0].n, got[0].x, got[0].s, got[0].b, got[0]["it's"], got[0]["'\""], got[0]["a.b"], got[0].m) == (1, 1.5, "a", True, 3, 4, "p", "1")
    assert got[0].o == '{"y":[1,2]}' and (got[1].n, got[1].x, got[1].m, got[1].z) == (2, 3.0, "two", None)
    assert all(v is None for i in (2, 3, 4) for v in got[i][1:])
    assert object_types(None) == object_types("VARIANT") == {}
    assert discover_types(df.filter("i = 2"), "j") == {} and expand_variant(df.filter("i = 2"), "j", ["i"]).columns == ["i"]


def test_bucketed_tables(spark, tmp_path):
    build = lambda: spark.range(5000).selectExpr("concat('u', id) as uid", "id as v")
    wide, made = C.load_once(spark, "bucketed_t", build, "uid", 8, str(tmp_path / "t"))
    assert made and not C.load_once(spark, "bucketed_t", build, "uid", 8, str(tmp_path / "t"))[1]
    assert C.clone_like(spark, "bucketed_t", "bucketed_c", str(tmp_path / "c")) and not C.clone_like(spark, "bucketed_t", "bucketed_c", "x")
    assert spark.table("bucketed_c").count() == 0 and spark.table("bucketed_c").columns == ["uid", "v"]
    keys = spark.range(0, 5000, 7).selectExpr("concat('u', id) as uid")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = C.semi_join(wide, keys, "uid")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.v for r in joined.collect()) == list(range(0, 5000, 7))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan  # of the keys only
    assert len(spark.read.parquet(str(tmp_path / "t")).inputFiles()) == 8
    spark.sql("drop table bucketed_t")
    spark.sql("drop table bucketed_c")
