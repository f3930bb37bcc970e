"""Ingest, JSON log, lifecycle and champion queries (OP-01..13, 24, 29,
63..68, 94..99, 109, 110)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from skydrift.functions.json import pack_json, pack_truth
from skydrift.operators import lifecycle as L
from skydrift.operators import monitor as MON
from skydrift.operators.scoring import (
    enforce_schema, expand_json, feature_union, retrain_projection)
from skydrift.operators.staging import ints_to_double
from skydrift.plans.oracle import with_fx
from skydrift.plans.registry import query
from skydrift.session import scratch_path, written
from skydrift.sources.fixtures import fx_predictions, fx_raw, fx_stg
from skydrift.sources.ingest import (
    cast_raw, pruned_columns, publish_csv, read_raw_text, sql_source)
from skydrift.sources.tables import register_views

# Two model signatures (name -> type) used by the scoring jobs.
SIG_REG = {"origin_airport_id": "long", "dest_airport_id": "long", "crs_dep_time": "long",
           "crs_elapsed_time": "double", "distance": "double", "tail_number": "string"}
SIG_CLS = {"origin_airport_id": "long", "dep_time_blk": "string", "day_of_week": "integer",
           "distance": "double", "marketing_airline_network": "string"}
LOG_FEATURES = ["origin_airport_id", "dest_airport_id", "tail_number", "dep_time_blk",
                "crs_dep_time", "crs_elapsed_time", "distance"]
LOG_FEATURES_TEXT = [f"cast({c} as varchar)" for c in LOG_FEATURES]


def _log(spark, sf_dir, stg=None):
    """The staging rows shaped as predictions-log rows (features and truth
    as JSON text; the log timestamp is the flight date)."""
    stg = fx_stg(spark, sf_dir) if stg is None else stg
    return stg.select(
        F.xxhash64("flight_uid").alias("id"),
        F.col("flight_date").cast("timestamp").alias("timestamp"), "flight_uid",
        pack_json(LOG_FEATURES).alias("input_features"),
        pack_truth("arr_delay_minutes", "arr_del15").alias("ground_truth"))


@query("typed_cast_from_text", with_fx(["fx_raw"], """
select flight_uid,
       cast(round(cast(nullif(cast(crs_elapsed_time as varchar), '') as decimal(38, 6))) as integer)
         as crs_elapsed_time_int,
       cast(round(cast(nullif(cast(crs_elapsed_time / 2 as varchar), '') as decimal(38, 6))) as integer)
         as half_elapsed_int,
       cast(round(cast(nullif(cast(-crs_elapsed_time / 2 as varchar), '') as decimal(38, 6))) as integer)
         as neg_half_elapsed_int,
       cast(nullif(cast(distance as varchar), '') as double) as distance,
       cast(nullif(cast(flight_date as varchar), '') as date) as flight_date,
       case when cancelled_text = 'True' then true when cancelled_text = 'False' then false end
         as cancelled
from (select *, case when cancelled then 'True' when not cancelled then 'False' else 'true' end
                as cancelled_text from fx_raw) r"""))
def q_typed_cast(spark, sf_dir):
    """OP-03: numbers round-tripped through text (``x.5`` values round half
    away from zero), dates, and booleans only from exact True/False (a
    lowercase ``true`` stands in for a malformed flag -> NULL)."""
    from skydrift.functions.exprs import (
        text_to_bool, text_to_date, text_to_double, text_to_int_rounded)
    raw = fx_raw(spark, sf_dir)
    c = F.col("crs_elapsed_time")
    txt = raw.select(
        "flight_uid", c.cast("string").alias("t_int"), (c / 2).cast("string").alias("t_half"),
        (-c / 2).cast("string").alias("t_neg"), F.col("distance").cast("string").alias("t_dist"),
        F.col("flight_date").cast("string").alias("t_date"),
        F.when(F.col("cancelled"), "True").when(~F.col("cancelled"), "False")
         .otherwise("true").alias("t_flag"))
    return txt.select("flight_uid", text_to_int_rounded("t_int").alias("crs_elapsed_time_int"),
                      text_to_int_rounded("t_half").alias("half_elapsed_int"),
                      text_to_int_rounded("t_neg").alias("neg_half_elapsed_int"),
                      text_to_double("t_dist").alias("distance"),
                      text_to_date("t_date").alias("flight_date"),
                      text_to_bool("t_flag").alias("cancelled"))


_CSV_COLS = [("flight_uid", "string"), ("flight_date", "date"), ("origin_airport_id", "int"),
             ("dest_airport_id", "int"), ("crs_dep_time", "int"),
             ("crs_elapsed_time", "double"), ("distance", "double"), ("cancelled", "boolean")]


@query("csv_ingest_roundtrip", with_fx(["fx_raw"], """
select flight_uid, flight_date, cast(origin_airport_id as integer) as origin_airport_id,
       cast(dest_airport_id as integer) as dest_airport_id,
       cast(crs_dep_time as integer) as crs_dep_time, crs_elapsed_time, distance, cancelled
from fx_raw"""))
def q_csv_ingest(spark, sf_dir):
    """OP-01/02/03/04/05: raw rows written as text CSV under the raw files' name
    pattern, one half in files with further columns, the other half in files
    of another column order, beside a file of another name that must be ignored
    and one that lacks a column and must be reported. All are scanned by name,
    cast in one projection and loaded once; a second load finds the table and
    writes nothing. The written count must be that of the scan."""
    names = [c for c, _ in _CSV_COLS]
    raw = fx_raw(spark, sf_dir).select(*names)
    folder = scratch_path(spark, "csv")
    half = F.pmod(F.xxhash64("flight_uid"), F.lit(2))
    wide = raw.filter(half == 0).select(F.lit("x").alias("source_file"), *names, F.lit("7").alias("extra"))
    publish_csv(wide, f"{folder}/in/wide", "Combined_Flights_2018.csv")
    publish_csv(raw.filter(half == 1).select(*names[::-1]), f"{folder}/in/turned", "Combined_Flights_2019.csv")
    publish_csv(raw.limit(1), f"{folder}/in/decoy", "Notes_2018.csv")
    publish_csv(raw.drop("distance").limit(1), f"{folder}/in/short", "Combined_Flights_2020.csv")
    skipped: list[str] = []
    typed = cast_raw(read_raw_text(spark, f"{folder}/in", columns=names, skipped=skipped), _CSV_COLS)
    L.load_once(spark, f"{folder}/typed", lambda: typed)
    table, again = L.load_once(spark, f"{folder}/typed", lambda: typed.limit(0))
    if not skipped or any("2020" not in f for f in skipped) or again is not None:
        raise RuntimeError(f"skipped {skipped}, loaded again: {again}")
    return table


@query("sql_source_pruned", with_fx(["fx_stg"], """
select cast(crs_dep_time as double) as crs_dep_time, cast(crs_elapsed_time as double)
         as crs_elapsed_time, cast(day_of_week as double) as day_of_week,
       dep_time_blk, cast(dest_airport_id as double) as dest_airport_id, distance,
       flight_uid, marketing_airline_network, cast(origin_airport_id as double)
         as origin_airport_id, tail_number, arr_delay_minutes, arr_del15
from fx_stg"""))
def q_sql_source(spark, sf_dir):
    """OP-06/12/24: an SQL-string source over registered views, pruned to
    the union of both signatures plus key and truths; integer features
    coerced to double."""
    fx_stg(spark, sf_dir).createOrReplaceTempView("fx_stg_view")
    cols = pruned_columns(SIG_REG, SIG_CLS, ["flight_uid"])
    df = sql_source(spark, f"select {', '.join(cols)}, arr_delay_minutes, arr_del15 "
                           f"from fx_stg_view")
    return ints_to_double(df, [c for c in cols if c != "flight_uid"])


@query("feature_union_log", with_fx(["fx_stg"], """
select flight_uid, crs_dep_time, crs_elapsed_time, day_of_week, dep_time_blk,
       dest_airport_id, distance, marketing_airline_network, origin_airport_id, tail_number
from fx_stg"""))
def q_feature_union(spark, sf_dir):
    """OP-64: the sorted union of both model signatures selects the logged
    feature columns."""
    feats = feature_union(SIG_REG, SIG_CLS)
    return fx_stg(spark, sf_dir).select("flight_uid", *feats)


@query("schema_enforce", with_fx(["fx_stg"], """
select flight_uid,
       try_cast(trunc(try_cast(cast(origin_airport_id as varchar) as double)) as bigint) as origin_airport_id,
       try_cast(trunc(try_cast(cast(dest_airport_id as varchar) as double)) as bigint) as dest_airport_id,
       try_cast(trunc(try_cast(cast(crs_dep_time as varchar) as double)) as bigint) as crs_dep_time,
       try_cast(cast(crs_elapsed_time as varchar) as double) as crs_elapsed_time,
       try_cast(cast(distance as varchar) as double) as distance,
       try_cast(dep_time_blk as double) as dep_time_blk,
       try_cast(trunc(try_cast(cast(crs_elapsed_time / 2 as varchar) as double)) as bigint) as half_elapsed,
       cast(tail_number as varchar) as tail_number
from fx_stg"""))
def q_schema_enforce(spark, sf_dir):
    """OP-63: coercion to a signature: numbers from text, bad text -> NULL
    (``dep_time_blk`` forced to double shows it); integers go through double
    and truncate toward zero like an int64 cast (``7.5`` -> 7)."""
    stg = fx_stg(spark, sf_dir).select(
        "flight_uid", "origin_airport_id", "dest_airport_id", "crs_dep_time",
        "crs_elapsed_time", "distance", "dep_time_blk", "tail_number",
        (F.col("crs_elapsed_time") / 2).alias("half_elapsed"))
    sig = dict(SIG_REG)
    sig.update({"dep_time_blk": "double", "half_elapsed": "long"})
    return enforce_schema(stg, sig).select(
        "flight_uid", "origin_airport_id", "dest_airport_id", "crs_dep_time",
        "crs_elapsed_time", "distance", "dep_time_blk", "half_elapsed", "tail_number")


@query("json_expand", with_fx(["fx_stg"], """
select flight_uid, cast(crs_dep_time as bigint) as crs_dep_time, crs_elapsed_time,
       dep_time_blk, cast(dest_airport_id as bigint) as dest_airport_id, distance,
       cast(origin_airport_id as bigint) as origin_airport_id, tail_number
from fx_stg"""))
def q_json_expand(spark, sf_dir):
    """OP-65/67: features serialised to JSON, then expanded back by the keys of
    the given types."""
    log = _log(spark, sf_dir)
    types = {"crs_dep_time": "bigint", "crs_elapsed_time": "double", "dep_time_blk": "string",
             "dest_airport_id": "bigint", "distance": "double", "origin_airport_id": "bigint",
             "tail_number": "string"}
    return expand_json(log, "input_features", ["flight_uid"], types)


@query("json_keys_discovered", with_fx(["fx_stg"], """
select json_key, count(*) as documents from (
  select unnest(json_keys(to_json(struct_pack(""" + ", ".join(f"{c} := {c}" for c in LOG_FEATURES) + """)))) as json_key,
         unnest(list_transform([""" + ", ".join(LOG_FEATURES_TEXT) + """], lambda v: v is not null)) as held
  from fx_stg) k where held group by 1"""))
def q_json_keys(spark, sf_dir):
    """OP-67 discovery: the keys of the logged feature objects, found in the
    data, and how many documents hold each (NULL-valued keys are dropped by the
    serialiser)."""
    keys = expand_json(_log(spark, sf_dir), "input_features", ["flight_uid"])
    held = [c for c in keys.columns if c != "flight_uid"]
    counts = keys.agg(*[F.count(c).alias(c) for c in held])
    return counts.unpivot([], held, "json_key", "documents").filter("documents > 0")


_RETRAIN_SCHEMA = T.StructType([
    T.StructField("flight_uid", T.StringType()), T.StructField("flight_date", T.DateType()),
    T.StructField("origin_airport_id", T.LongType()),
    T.StructField("dest_airport_id", T.LongType()),
    T.StructField("crs_dep_time", T.LongType()),
    T.StructField("crs_elapsed_time", T.DoubleType()),
    T.StructField("distance", T.DoubleType()),
    T.StructField("dep_time_blk", T.StringType()),
    T.StructField("year", T.LongType()),
    T.StructField("arr_delay_minutes", T.DoubleType()),
    T.StructField("arr_del15", T.IntegerType())])


@query("json_retrain_projection", with_fx(["fx_stg"], """
select flight_uid, flight_date, cast(origin_airport_id as bigint) as origin_airport_id,
       cast(dest_airport_id as bigint) as dest_airport_id,
       cast(crs_dep_time as bigint) as crs_dep_time, crs_elapsed_time, distance, dep_time_blk,
       cast(null as bigint) as year, arr_delay_minutes, arr_del15
from fx_stg"""))
def q_retrain_projection(spark, sf_dir):
    """OP-66: log rows -> typed retrain rows by the target schema; ``year``
    is not a logged feature, so it stays NULL (Q7)."""
    return retrain_projection(_log(spark, sf_dir), _RETRAIN_SCHEMA)


@query("materialise_sorted", with_fx(["fx_stg"], """
select year, month, count(*) as rows, min(flight_date) as min_date, max(flight_date) as max_date
from fx_stg group by year, month"""))
def q_materialise(spark, sf_dir):
    """OP-07/32: CTAS of the staging table partitioned by (year, month),
    date-sorted within files; read back through partition pruning."""
    path = scratch_path(spark, "stg")
    L.materialise_sorted(fx_stg(spark, sf_dir), path, ["year", "month"], ["flight_date", "flight_uid"])
    t = spark.read.parquet(path)
    return t.groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows"),
                                          F.min("flight_date").alias("min_date"),
                                          F.max("flight_date").alias("max_date"))


@query("retrain_clone_append", with_fx(["fx_stg"], """
select source, count(*) as rows, cast(sum(arr_del15) as bigint) as delayed from (
  select 'reference' as source, arr_del15 from fx_stg
  where flight_date < date '1999-01-01'
    and cast(('0x' || substr(md5(flight_uid), 1, 8)) as bigint) % 1000 < 10
  union all
  select 'appended', arr_del15 from fx_stg where flight_date >= date '1999-01-01') u
group by source"""))
def q_retrain_clone_append(spark, sf_dir):
    """OP-08/09/10: retrain table = copy of the reference sample (empty clone
    first), then labelled log rows of the current period appended through
    the JSON projection."""
    from skydrift.operators.sampling import hash_sample
    stg = fx_stg(spark, sf_dir)
    split = F.lit("1999-01-01").cast("date")
    base = hash_sample(stg.filter(F.col("flight_date") < split), "flight_uid", 10) \
        .select(*[F.col(f.name).cast(f.dataType) for f in _RETRAIN_SCHEMA.fields])
    path = scratch_path(spark, "retrain")
    base = base.withColumn("source", F.lit("reference"))
    L.clone_empty(base, path)
    L.append_batch(base, path, 0)
    log = _log(spark, sf_dir).filter(F.col("timestamp") >= split.cast("timestamp"))
    L.append_batch(retrain_projection(log, _RETRAIN_SCHEMA).withColumn("source", F.lit("appended")), path, 1)
    return spark.read.parquet(path).groupBy("source").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("arr_del15").cast("bigint").alias("delayed"))


@query("retrain_cycle", with_fx(["fx_stg"], """
select 'reference' as part, count(*) as rows, cast(sum(arr_del15) as bigint) as delayed,
       min(flight_date) as first_date from fx_stg
where flight_date < date '1999-01-01'
  and cast(('0x' || substr(md5(flight_uid), 1, 8)) as bigint) % 1000 < 10
union all
select 'appended', count(*), cast(sum(arr_del15) as bigint), min(flight_date) from fx_stg
where year in (1999, 2000)
union all
select 'left in the log', count(*), cast(sum(arr_del15) as bigint), min(flight_date) from fx_stg
where year >= 2001"""))
def q_retrain_cycle(spark, sf_dir):
    """OP-04/08/09/10/11/66, the retrain operation as one: the retrain table is
    cloned empty when absent and given the reference sample; the labelled log
    rows of the batches at hand are projected by the table's own schema and
    appended to that same table; a later batch arrives meanwhile; then the
    consumed batches are cleared, and only those. Each append is retried once,
    which must change nothing."""
    from skydrift.operators.sampling import hash_sample
    stg = written(fx_stg(spark, sf_dir), "staging")  # read by four appends and their retries
    table, log = scratch_path(spark, "retrain"), scratch_path(spark, "log")
    base = hash_sample(stg.filter(F.col("flight_date") < F.lit("1999-01-01").cast("date")),
                       "flight_uid", 10) \
        .select(*[F.col(f.name).cast(f.dataType) for f in _RETRAIN_SCHEMA.fields])
    made = L.clone_empty(base, table), L.clone_empty(base, table)
    if made != (True, False):
        raise RuntimeError(f"cloned: {made}")
    L.append_batch(base, table, 0)

    def arrive(year):
        rows = _log(spark, sf_dir, stg).filter(F.year("timestamp") == year)
        return L.append_batch(rows, log, year)

    arrive(1999), arrive(2000), arrive(2000)
    held = spark.read.parquet(log)
    upto = held.agg(F.max(L.BATCH)).first()[0]
    target = T.StructType([f for f in spark.read.parquet(table).schema.fields if f.name != L.BATCH])
    rows = retrain_projection(held.filter(F.col(L.BATCH) <= upto), target)
    L.append_batch(rows, table, upto), L.append_batch(rows, table, upto)
    arrive(2001)  # between the append and the clearing
    L.rotate_log(spark, log, upto, log + "-next")

    def summary(df, part):
        return df.agg(F.count(F.lit(1)).alias("rows"), F.sum("arr_del15").cast("bigint").alias("delayed"),
                      F.min("flight_date").alias("first_date")) \
            .select(F.lit(part).alias("part"), "rows", "delayed", "first_date")
    t, left = spark.read.parquet(table), spark.read.parquet(log + "-next")
    return summary(t.filter(F.col(L.BATCH) == 0), "reference") \
        .unionByName(summary(t.filter(F.col(L.BATCH) > 0), "appended")) \
        .unionByName(summary(retrain_projection(left, target), "left in the log"))


@query("log_rotate", with_fx(["fx_predictions"], """
select dayofmonth(ts) as batch_id, count(*) as remaining, min(id) as first_id from fx_predictions
where dayofmonth(ts) > 15 group by 1"""))
def q_log_rotate(spark, sf_dir):
    """OP-10/11 + Q12: the log's daily batches are consumed up to a fixed batch;
    those that arrived after it are kept, with their ids."""
    p = fx_predictions(spark, sf_dir).withColumn(L.BATCH, F.dayofmonth("ts"))
    path = scratch_path(spark, "log")
    L.write_counted(p, path, [L.BATCH])
    L.rotate_log(spark, path, 15, path + "-next")
    return spark.read.parquet(path + "-next").groupBy(F.col(L.BATCH).cast("bigint").alias("batch_id")) \
        .agg(F.count(F.lit(1)).alias("remaining"), F.min("id").alias("first_id"))


_DAILY = """daily AS (
  select cast(ts as date) as day, avg(abs(true_reg - prediction_reg)) as mae,
         sqrt(avg((true_reg - prediction_reg) * (true_reg - prediction_reg))) as rmse,
         avg(case when true_class = prediction_class then 1.0 else 0.0 end) as accuracy
  from fx_predictions group by 1)"""


def _daily(spark, sf_dir):
    p = fx_predictions(spark, sf_dir)
    e = F.col("true_reg") - F.col("prediction_reg")
    return p.groupBy(F.to_date("ts").alias("day")).agg(
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.when(F.col("true_class") == F.col("prediction_class"), 1.0).otherwise(0.0))
         .alias("accuracy"))


@query("promote_decision", with_fx(["fx_predictions"], """
select day, rmse, champion_score, champion_score is null or rmse < champion_score as promoted,
       rmse - champion_score as delta_vs_champion
from (select *, min(rmse) over (order by day rows between unbounded preceding and 1 preceding)
                as champion_score from daily) d""", _DAILY))
def q_promote(spark, sf_dir):
    """OP-94/97: each daily candidate vs the champion so far (strictly
    better RMSE promotes; no champion -> promote)."""
    runs = _daily(spark, sf_dir).select("day", "rmse")
    return L.promotion_decisions(runs, "rmse", ["day"], "minimize")


@query("run_log", with_fx(["fx_predictions"], """
select day, printf('%.4f', mae) as mae_tag, printf('%.4f', rmse) as rmse_tag,
       printf('%.4f', accuracy) as accuracy_tag from daily""", _DAILY))
def q_run_log(spark, sf_dir):
    """OP-95/96: metric tags (4 decimals) of each daily run."""
    return L.metric_tags(_daily(spark, sf_dir), ["mae", "rmse", "accuracy"]) \
        .select("day", "mae_tag", "rmse_tag", "accuracy_tag")


@query("model_age", with_fx(["fx_predictions"], """
select cast(ts as date) as day,
       (epoch(timestamp '2024-02-01 00:00:00') - floor(epoch(min(ts)))) / 3600.0 as age_hours
from fx_predictions group by 1"""))
def q_model_age(spark, sf_dir):
    """OP-99: hours from each daily run's start to a fixed 'now'."""
    p = fx_predictions(spark, sf_dir)
    runs = p.groupBy(F.to_date("ts").alias("day")).agg(F.min("ts").alias("start_ts"))
    return MON.model_age_hours(runs, "2024-02-01 00:00:00").select("day", "age_hours")


@query("alarm_timeline", with_fx(["fx_predictions"], """
select model, ts, kind, coalesce(last_value(a ignore nulls) over w, 0) as alarm,
       coalesce(last_value(r ignore nulls) over w, 0) as retrain,
       cast(sum(case when kind = 'drift' then 1 else 0 end) over w as bigint) as episode
from (select *, case kind when 'drift' then 1 when 'promote' then 0 end as a,
                case kind when 'drift' then 0 when 'promote' then 1 end as r,
                case kind when 'drift' then 0 when 'promote' then 1 else 2 end as prio
      from events_t) e
window w as (partition by model order by ts, prio rows between unbounded preceding and current row)
""", _DAILY + """,
events_t AS (
  select 'reg' as model, cast(day as timestamp) as ts,
         case when mae > 43 then 'drift' when mae < 42 then 'promote' else 'batch' end as kind
  from daily
  union all
  select 'class', cast(day as timestamp),
         case when accuracy < 0.49 then 'drift' when accuracy > 0.51 then 'promote' else 'batch' end
  from daily)"""))
def q_alarm_timeline(spark, sf_dir):
    """OP-109: alarm / retrain flags over an event stream derived from the
    daily metrics of both models (per-model window over the events)."""
    d = _daily(spark, sf_dir)
    reg = d.select(F.lit("reg").alias("model"), F.col("day").cast("timestamp_ntz").alias("ts"),
                   F.when(F.col("mae") > 43, "drift").when(F.col("mae") < 42, "promote")
                    .otherwise("batch").alias("kind"))
    cls = d.select(F.lit("class").alias("model"), F.col("day").cast("timestamp_ntz").alias("ts"),
                   F.when(F.col("accuracy") < 0.49, "drift")
                    .when(F.col("accuracy") > 0.51, "promote").otherwise("batch").alias("kind"))
    return MON.alarm_timeline(reg.unionByName(cls)).select(
        "model", "ts", "kind", "alarm", "retrain", "episode")


@query("metric_series_seed", with_fx(["fx_predictions"], """
select 'delay_regressor_v' || cast(version as varchar) || '@champion' as champion_label,
       name, value from (
  select version, unnest(['mae', 'rmse', 'drift_score']) as name,
         unnest([mae, rmse, 0.05]) as value
  from (select row_number() over (order by day) as version, mae, rmse from daily) v
  where version = (select count(*) from daily)) s""", _DAILY))
def q_metric_series(spark, sf_dir):
    """OP-110: the champion (latest daily run) seeds a long metric series,
    drift starts at 0.05; label ``name_vN@alias``."""
    from pyspark.sql import Window
    d = _daily(spark, sf_dir)
    v = d.withColumn("version", F.row_number().over(Window.orderBy("day")))  # one row per day
    champ = v.orderBy(F.col("version").desc()).limit(1).select(
        "version", F.create_map(F.lit("mae"), F.col("mae"), F.lit("rmse"), F.col("rmse"))
        .alias("metrics"))
    return MON.metric_series_seed(champ, ["mae", "rmse"], "delay_regressor")


@query("champion_comparison", with_fx(["fx_predictions"], """
select c.name, c.champion_value, n.current_value, n.current_value - c.champion_value as delta
from (select unnest(['mae', 'rmse']) as name, unnest([mae, rmse]) as champion_value
      from daily where day = (select min(day) from daily)) c
full outer join (select unnest(['mae', 'rmse']) as name, unnest([mae, rmse]) as current_value
      from daily where day = (select max(day) from daily)) n on c.name = n.name""", _DAILY))
def q_champion_comparison(spark, sf_dir):
    """OP-97: champion (first day) metrics vs the current batch (last day)."""
    d = _daily(spark, sf_dir)

    def long(df, col):
        return df.select(F.explode(F.create_map(F.lit("mae"), F.col("mae"), F.lit("rmse"),
                                                F.col("rmse"))).alias("name", "value"))
    first = d.join(d.agg(F.min("day").alias("day")), "day")
    last = d.join(d.agg(F.max("day").alias("day")), "day")
    return MON.champion_comparison(long(first, "c"), long(last, "n")) \
        .select("name", "champion_value", "current_value", "delta")


@query("registered_views_sql", with_fx(["fx_stg"], """
select l_returnflag, count(*) as n, round(sum(l_quantity), 2) as qty
from lineitem group by l_returnflag"""))
def q_registered_views(spark, sf_dir):
    """OP-06 over the raw registered tables (a plain SQL-string source)."""
    register_views(spark, sf_dir, ["lineitem"])
    return sql_source(spark, "select l_returnflag, count(*) as n, "
                             "round(sum(l_quantity), 2) as qty from lineitem group by l_returnflag")
