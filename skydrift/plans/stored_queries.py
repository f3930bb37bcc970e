"""Stored tables, models and streams that go on (OP-04, 07, 08, 10, 11, 28, 35,
47, 60, 67, 94-97, 103, 106, 108)."""

from __future__ import annotations

import hashlib

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from skydrift.operators import catalogue as C
from skydrift.operators import drift as D
from skydrift.operators import monitor as MON
from skydrift.operators.batches import BatchTables
from skydrift.operators.features import Preprocessor
from skydrift.operators.modelstore import ModelStore
from skydrift.operators.models import fit_model, run_row
from skydrift.operators.sampling import date_range, earliest_n, hash_sample
from skydrift.operators.scoring import expand_variant, retrain_projection
from skydrift.operators.tuning import search
from skydrift.functions.json import discover_types
from skydrift.plans.drift_queries import drift_ctes
from skydrift.plans.log_queries import _RETRAIN_SCHEMA, LOG_FEATURES, _log
from skydrift.plans.model_queries import _split
from skydrift.plans.oracle import with_fx
from skydrift.plans.registry import ORACLES, query
from skydrift.plans.sampling_queries import SAMPLE_END, SAMPLE_LIMIT, SAMPLE_START
from skydrift.session import scratch_path, written
from skydrift.sources.fixtures import calendar_and_targets, fx_raw_from, fx_stg
from skydrift.sources.tables import read_table
from skydrift.streaming import jobs as S
from skydrift.streaming import state as ST

#: Files of a stream arrive in so many parts.
PARTS = 4
_PART_SQL = f"cast(split_part(flight_uid, '_', 1) as bigint) % {PARTS}"


def _arriving(df, part, folder):
    """The rows of ``df`` written to a stream's folder part after part."""
    for k in range(PARTS):
        df.filter(part == k).write.mode("append").parquet(folder)
        yield k


@query("rolling_std_null_keys", with_fx(["fx_stg"], """
select flight_uid, nullif(dest_airport_id, 7) as dest,
       stddev_samp(distance) over (partition by nullif(dest_airport_id, 7) order by flight_date, flight_uid
                                   rows between 99 preceding and current row) as rolling_std
from fx_stg"""))
def q_rolling_null_keys(spark, sf_dir):
    """OP-35: the trailing 100 of each destination, one of which is NULL."""
    rows = fx_stg(spark, sf_dir).select("flight_uid", "flight_date", "distance", F.nullif("dest_airport_id", F.lit(7)).alias("dest"))
    return MON.rolling_std_window(rows, "distance", ["dest"], ["flight_date", "flight_uid"], 100).select("flight_uid", "dest", "rolling_std")


@query("stream_last100_std", f"""
select cast(batch_id as integer) as batch_id, event_type as key, count(*) as n_rows, stddev_samp(value) as rolling_std
from (select b as batch_id, event_type, value, row_number() over (partition by b, event_type order by ts desc, event_id desc) as place
      from events, range(0, {PARTS}) t(b) where event_id % {PARTS} <= b) e
where place <= 100 group by batch_id, event_type""")
def q_stream_last100(spark, sf_dir):
    """OP-106/35: the std of each type's newest 100 values after every
    micro-batch, from a state of 100 rows a type; the stream stops and goes on
    between its micro-batches, and the rows arrive in no order of time."""
    events = read_table(spark, sf_dir, "events")
    folder, sink, ckpt = (scratch_path(spark, f"last100-{x}") for x in ("in", "out", "ckpt"))
    for _ in _arriving(events, F.col("event_id") % PARTS, folder):
        stream = spark.readStream.schema(events.schema).parquet(folder)
        with ST.rocksdb_state(spark):
            S.run_available(ST.newest_std(stream, "event_type", "ts", "event_id", "value"), "last100", "update", S.batch_folder, sink, ckpt)
    return spark.read.parquet(sink)


_NUM, _CAT = ["day_of_week", "crs_dep_time", "crs_elapsed_time", "distance"], ["marketing_airline_network", "dep_time_blk"]
_CUR_SQL = f"""cur_raw AS (
  select *, cast(isodow(flight_date) as integer) as day_of_week, {_PART_SQL} as part from fx_raw
  where cancelled = false and origin_airport_id is not null and distance > 0 and flight_date >= date '1999-01-01'),
"""


def _prefix_sql(batch: int) -> str:
    return with_fx(["fx_stg"], f"""
select count(*) as n_columns, cast(sum(case when drifted then 1 else 0 end) as bigint) as n_drifted,
       avg(case when drifted then 1.0 else 0.0 end) as drift_score, avg(case when drifted then 1.0 else 0.0 end) > 0.5 as alarm,
       cast({batch} as integer) as batch_id
from report""", _CUR_SQL + drift_ctes(_NUM, _CAT, cur_src="cur_raw", cur_where=f"part <= {batch}"))


@query("stream_drift_batches", "\nunion all\n".join(f"select * from ({_prefix_sql(b)}) p{b}" for b in range(PARTS)))
def q_stream_drift_batches(spark, sf_dir):
    """OP-108: an alarm row after every micro-batch, from counts of values kept as
    state. Ship dates come in no order, so nothing is late and nothing expires here."""
    split = F.lit("1999-01-01").cast("date")
    ref = D.drop_present(fx_stg(spark, sf_dir).filter(F.col("flight_date") < split))
    lineitem = read_table(spark, sf_dir, "lineitem")
    folder, sink, ckpt = (scratch_path(spark, f"drift-{x}") for x in ("in", "out", "ckpt"))
    per_batch = S.drift_running(ref, _NUM, _CAT)
    for _ in _arriving(lineitem, F.col("l_orderkey") % PARTS, folder):
        raw = fx_raw_from(spark.readStream.schema(lineitem.schema).parquet(folder))
        cur = calendar_and_targets(raw.filter((F.col("cancelled") == F.lit(False)) & F.col("origin_airport_id").isNotNull()
                                              & (F.col("distance") > 0) & (F.col("flight_date") >= split)))
        with ST.rocksdb_state(spark, idle_batches=False):
            S.run_available(ST.running_counts(cur, _NUM, _CAT, "flight_date", 100_000, "3650 days"), "drift", "update", per_batch, sink, ckpt)
    return spark.read.parquet(f"{sink}/alarms")


@query("stream_champion_switch", with_fx(["fx_raw"], f"""
select cast(part as integer) as batch_id, case when part < 2 then 'delay_regressor_v1' else 'delay_regressor_v2' end as model_version_reg,
       'delay_classifier_v1' as model_version_class, count(*) as n, count(distinct flight_uid) as flights
from (select *, {_PART_SQL} as part from fx_raw where cancelled = false and origin_airport_id is not null and distance > 0) r
group by part"""))
def q_champion_switch(spark, sf_dir):
    """OP-97/103: a stream scored by stored champions; one is replaced while it
    runs, and the next micro-batch is scored by its successor."""
    store = ModelStore(spark, scratch_path(spark, "store"))
    train, _, _ = _split(spark, sf_dir)
    small = Preprocessor(low_card_cols=["dep_time_blk"], high_card_cols=["origin_airport_id"], cyclic_cols=["crs_dep_time"],
                         numeric_cols=["crs_elapsed_time"], skewed_numeric_cols=["distance"], target="arr_delay_minutes")
    fitted = small.fit(train, stored=True)
    made = {}
    for name, kind, label, depth in (("delay_regressor", "RandomForestRegressor", "arr_delay_minutes", 2),
                                     ("delay_regressor", "RandomForestRegressor", "arr_delay_minutes", 4),
                                     ("delay_classifier", "RandomForestClassifier", "arr_del15", 2)):
        params = {"n_estimators": 3, "max_depth": depth, "random_state": 42}
        model = fit_model(train, kind, params, label, prepared=fitted, feats=fitted.transform(train, columns=False))
        run = run_row(spark, model, params, spark.createDataFrame([(1.0 / depth,)], "depth_score double"), name, {"name": "fx_stg"})
        version = store.register(name, model, run)
        made[version.label] = version
    store.promote(made["delay_regressor_v1"])
    store.promote(made["delay_classifier_v1"])
    lineitem = read_table(spark, sf_dir, "lineitem")
    folder, sink, ckpt = (scratch_path(spark, f"switch-{x}") for x in ("in", "out", "ckpt"))
    for k in _arriving(lineitem, F.col("l_orderkey") % PARTS, folder):
        raw = fx_raw_from(spark.readStream.schema(lineitem.schema).parquet(folder))
        clean = calendar_and_targets(raw.filter((F.col("cancelled") == F.lit(False)) & F.col("origin_airport_id").isNotNull()
                                                & (F.col("distance") > 0)))
        S.run_available(clean, "switch", "append", S.score_with_champions(store, {"reg": "delay_regressor", "cls": "delay_classifier"}), sink, ckpt)
        if k == 1:
            store.promote(made["delay_regressor_v2"])
    return spark.read.parquet(sink).groupBy("batch_id", "model_version_reg", "model_version_class") \
        .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("flight_uid").alias("flights"))


@query("tune_adaptive")
def q_tune_adaptive(spark, sf_dir):
    """OP-60/61: trials drawn by a Parzen estimator once the first are known."""
    train, val, _ = _split(spark, sf_dir)
    space = {"max_depth": ("int", 2, 6), "n_estimators": ("int", 2, 6)}
    prep = Preprocessor(low_card_cols=["dep_time_blk"], cyclic_cols=["crs_dep_time"], numeric_cols=["crs_elapsed_time"],
                        skewed_numeric_cols=["distance"])
    return search(spark, train, val, "RandomForestRegressor", "arr_delay_minutes", space, {"random_state": 42}, 10, "rmse", "minimize", prep=prep, stored=True)


@query("onehot_sparse", with_fx(["fx_stg"], """
select cast(row_number() over (order by source, level, tail) - 1 as integer) as slot, n from (
  select 0 as source, tail_number as tail, 0 as level, cast(count(*) as double) as n from fx_stg group by tail_number
  union all
  select 1, '', dest_airport_id, cast(count(*) as double) from fx_stg group by dest_airport_id) s"""))
def q_onehot_sparse(spark, sf_dir):
    """OP-47 for columns of many levels: sparse vectors from a table of levels; how
    many rows have each slot set."""
    stg = fx_stg(spark, sf_dir).select("tail_number", "dest_airport_id")
    fitted = Preprocessor(low_card_cols=["tail_number", "dest_airport_id"], low_card_strategy="sparse").fit(stg)
    total = fitted.transform(stg).agg(Summarizer.sum(F.col("features")).alias("n"))  # one number a slot
    return total.select(F.posexplode(vector_to_array("n")).alias("slot", "n"))


@query("json_typed_discovery", with_fx(["fx_stg"], f"""
select json_key, case when max(kind = 'VARCHAR') then 'string' when max(kind = 'DOUBLE') then 'double' else 'bigint' end as json_type,
       count(*) as documents
from (select json_key, json_type(doc, '$.' || json_key) as kind
      from (select doc, unnest(json_keys(doc)) as json_key
            from (select to_json(struct_pack({", ".join(f"{c} := {c}" for c in LOG_FEATURES)})) as doc from fx_stg) d) k) t
where kind <> 'NULL' group by json_key"""))
def q_json_typed(spark, sf_dir):
    """OP-67/68: keys and types of the logged feature objects from one aggregate over
    the documents as variants, and how many documents hold each."""
    log = written(_log(spark, sf_dir).select("input_features"), "log")  # made once, read twice
    types = discover_types(log, "input_features")
    held = expand_variant(log, "input_features", types=types).agg(*[F.count(c).alias(c) for c in types])
    named = F.create_map(*[F.lit(x) for item in types.items() for x in item])
    return held.unpivot([], list(types), "json_key", "documents").select("json_key", named[F.col("json_key")].alias("json_type"), "documents")


@query("json_expand_typed", ORACLES["json_expand"])
def q_json_expand_typed(spark, sf_dir):
    """OP-65/67: features serialised to JSON, then expanded by the keys and types
    found in them."""
    log = written(_log(spark, sf_dir).select("flight_uid", "input_features"), "log")
    return expand_variant(log, "input_features", ["flight_uid"])


@query("bucketed_semi_join", ORACLES["hash_sample_semi_join"])
def q_bucketed_semi_join(spark, sf_dir):
    """OP-04/07/28: staging rows as a catalogue table in buckets of the key, built
    once a session; the sampled keys' rows are fetched without a shuffle of it."""
    name = f"stg_flights_{hashlib.md5(sf_dir.encode()).hexdigest()[:12]}"
    wide, _ = C.load_once(spark, name, lambda: fx_stg(spark, sf_dir), "flight_uid", 16, scratch_path(spark, name))
    keys = earliest_n(hash_sample(date_range(wide.select("flight_uid", "flight_date"), "flight_date", SAMPLE_START, SAMPLE_END),
                                  "flight_uid", 10), "flight_date", "flight_uid", SAMPLE_LIMIT)
    return C.semi_join(wide, keys, "flight_uid")


@query("log_commit", with_fx(["fx_stg"], """
select case when crs_dep_time % 3 < 2 then 'retrain' else 'log' end as table_name, count(*) as rows,
       count(distinct flight_uid) as flights, cast(0 as bigint) as shared
from fx_stg group by 1"""))
def q_log_commit(spark, sf_dir):
    """OP-08/10/11: log batches become one batch of the retrain table and leave the
    log in the same commit; a third batch arrives meanwhile and stays; a retry of
    the commit changes nothing."""
    stg = written(fx_stg(spark, sf_dir), "staging")
    log = written(_log(spark, sf_dir, stg).join(stg.select("flight_uid", (F.col("crs_dep_time") % 3).alias("part")), "flight_uid"), "log")
    tables = BatchTables(spark, scratch_path(spark, "batches"))
    tables.create("log", log.drop("part").schema)
    tables.create("retrain", _RETRAIN_SCHEMA)
    for k in range(2):
        tables.append(log.filter(F.col("part") == k).drop("part"), "log", k)
    consumed = tables.batches("log")
    tables.append(log.filter("part = 2").drop("part"), "log", 2)
    for _ in range(2):
        tables.move("log", consumed, "retrain", 0, lambda df: retrain_projection(df, _RETRAIN_SCHEMA))
    now = {t: tables.read(t).select("flight_uid") for t in ("log", "retrain")}
    shared = now["log"].join(now["retrain"], "flight_uid", "left_semi").agg(F.count(F.lit(1))).scalar()
    parts = [df.agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("rows"), F.count_distinct("flight_uid").alias("flights"))
             for t, df in now.items()]
    return parts[0].unionByName(parts[1]).withColumn("shared", shared)
