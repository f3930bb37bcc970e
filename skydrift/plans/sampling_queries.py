"""Sampling, ordered limits and the chronological split (OP-14, 18, 28, 32-34,
38-44)."""

from __future__ import annotations

from pyspark.sql import functions as F

from skydrift.operators.sampling import (
    bernoulli, date_range, earliest_n, equalise, hash_sample, latest_n, monthly_batches,
    seeded_fixed_size, semi_join_keys, staged_downsample)
from skydrift.operators.split import chrono_split_labels
from skydrift.plans.oracle import with_fx
from skydrift.plans.registry import query
from skydrift.session import written
from skydrift.sources.fixtures import fx_predictions, fx_stg

# The training window and sample rule of the reference sampler,
# re-dated onto the fixture calendar (end exclusive).
SAMPLE_START, SAMPLE_END = "1995-01-01", "1998-12-31"
SAMPLE_LIMIT = 100_000  # bound of the training rows
HASH_SQL = "cast(('0x' || substr(md5(flight_uid), 1, 8)) as bigint) % 1000"


@query("hash_sample", with_fx(["fx_stg"], f"""
select flight_uid, flight_date from fx_stg
where flight_date >= date '{SAMPLE_START}' and flight_date < date '{SAMPLE_END}'
  and {HASH_SQL} < 10"""))
def q_hash_sample(spark, sf_dir):
    """OP-18 + OP-38: half-open date window, deterministic ~1 % key sample."""
    stg = date_range(fx_stg(spark, sf_dir), "flight_date", SAMPLE_START, SAMPLE_END)
    return hash_sample(stg, "flight_uid", 10).select("flight_uid", "flight_date")


@query("hash_sample_semi_join", with_fx(["fx_stg"], f"""
select * from fx_stg where flight_uid in (
  select flight_uid from fx_stg
  where flight_date >= date '{SAMPLE_START}' and flight_date < date '{SAMPLE_END}'
    and {HASH_SQL} < 10
  order by flight_date, flight_uid limit {SAMPLE_LIMIT})"""))
def q_hash_sample_semi_join(spark, sf_dir):
    """OP-28 + OP-33: sample and cap on two columns (``SAMPLE_LIMIT`` bounds the
    training rows), then fetch wide rows with a semi-join."""
    stg = fx_stg(spark, sf_dir)
    keys = earliest_n(hash_sample(date_range(stg.select("flight_uid", "flight_date"),
                                             "flight_date", SAMPLE_START, SAMPLE_END),
                                  "flight_uid", 10),
                      "flight_date", "flight_uid", SAMPLE_LIMIT)
    return semi_join_keys(stg, keys, "flight_uid")


@query("earliest_n", with_fx(["fx_stg"], """
select * from fx_stg order by flight_date, flight_uid limit 1000"""))
def q_earliest_n(spark, sf_dir):
    return earliest_n(fx_stg(spark, sf_dir), "flight_date", "flight_uid", 1000)


@query("earliest_n_large", with_fx(["fx_stg"], """
select flight_uid, flight_date from fx_stg order by flight_date, flight_uid limit 20000"""))
def q_earliest_n_large(spark, sf_dir):
    """Any n: a cut on the order columns, then a filter."""
    return earliest_n(fx_stg(spark, sf_dir).select("flight_uid", "flight_date"),
                      "flight_date", "flight_uid", 20000)


@query("latest_n", with_fx(["fx_predictions"], """
select id, ts, prediction_reg, prediction_class, true_reg, true_class
from fx_predictions order by ts desc, id desc limit 5000"""))
def q_latest_n(spark, sf_dir):
    """OP-34 / OP-14: newest 5000 log rows (ties broken by id)."""
    p = fx_predictions(spark, sf_dir).select("id", "ts", "prediction_reg", "prediction_class",
                                             "true_reg", "true_class")
    return latest_n(p, "ts", "id", 5000)


@query("seeded_fixed_size_sample", with_fx(["fx_stg"], """
select flight_uid, flight_date, distance from fx_stg
order by md5(concat('42', flight_uid)), flight_uid limit 500"""))
def q_seeded_fixed_size(spark, sf_dir):
    """OP-40: reproducible uniform fixed-size sample (md5 order)."""
    return seeded_fixed_size(fx_stg(spark, sf_dir).select("flight_uid", "flight_date",
                                                         "distance"),
                             "flight_uid", 500, 42)


def _unit(seed: int, key: str = "flight_uid") -> str:
    return (f"(cast(('0x' || substr(md5(concat('{seed}', {key})), 1, 8)) as bigint) % {1 << 30}) "
            f"/ {float(1 << 30)}::double")


@query("bernoulli_sample", with_fx(["fx_stg"], f"""
select flight_uid, flight_date from fx_stg where {_unit(42)} < 0.04"""))
def q_bernoulli(spark, sf_dir):
    """OP-39: seeded Bernoulli 4 % sample."""
    return bernoulli(fx_stg(spark, sf_dir), 0.04, "flight_uid", 42).select("flight_uid", "flight_date")


@query("retrain_sample", with_fx(["fx_stg"], f"""
select * from fx_stg
where flight_date >= date '1995-01-01' and flight_date < date '1999-01-01' and {_unit(42)} < 0.04
order by md5(concat('43', flight_uid)), flight_uid limit {SAMPLE_LIMIT}"""))
def q_retrain_sample(spark, sf_dir):
    """OP-39 + OP-40 + OP-32: Bernoulli pre-filter, seeded fixed-size cap
    (``SAMPLE_LIMIT`` bounds the training rows), sorted by date (the retrain
    table recipe)."""
    pre = bernoulli(date_range(fx_stg(spark, sf_dir), "flight_date", "1995-01-01",
                               "1999-01-01"), 0.04, "flight_uid", 42)
    return seeded_fixed_size(pre, "flight_uid", SAMPLE_LIMIT, 43) \
        .sortWithinPartitions("flight_date")


_SPLIT_CTE = """numbered AS (
  select flight_uid, flight_date,
         row_number() over (order by flight_date, flight_uid) - 1 as pos,
         count(*) over () as n
  from fx_stg),
labelled AS (
  select flight_uid, flight_date, pos,
         case when pos < floor(n * 0.7) then 'train'
              when pos < floor(n * 0.85) then 'val' else 'test' end as part
  from numbered)"""


@query("chrono_split_counts", with_fx(["fx_stg"], """
select part, count(*) as rows, min(pos) as first_pos, max(pos) as last_pos,
       min(flight_date) as min_date, max(flight_date) as max_date
from labelled group by part""", _SPLIT_CTE))
def q_chrono_split_counts(spark, sf_dir):
    """OP-41: part sizes int(n*0.7) / int(n*0.85) / rest and their ranges."""
    lab = chrono_split_labels(fx_stg(spark, sf_dir).select("flight_uid", "flight_date"),
                              ["flight_date", "flight_uid"])
    return lab.groupBy("part").agg(F.count(F.lit(1)).alias("rows"),
                                   F.min("pos").alias("first_pos"),
                                   F.max("pos").alias("last_pos"),
                                   F.min("flight_date").alias("min_date"),
                                   F.max("flight_date").alias("max_date"))


@query("chrono_split_rows", with_fx(["fx_stg"], """
select flight_uid, pos, part from labelled""", _SPLIT_CTE))
def q_chrono_split_rows(spark, sf_dir):
    lab = chrono_split_labels(fx_stg(spark, sf_dir).select("flight_uid", "flight_date"),
                              ["flight_date", "flight_uid"])
    return lab.select("flight_uid", "pos", "part")


@query("equalised_samples", with_fx(["fx_stg"], """
select side, count(*) as rows, min(flight_uid) as min_uid, max(flight_uid) as max_uid
from (
  select 'reference' as side, flight_uid,
         row_number() over (order by md5(concat('42', flight_uid)), flight_uid) as rn
  from fx_stg where flight_date < date '1999-01-01'
  union all
  select 'current', flight_uid,
         row_number() over (order by md5(concat('24', flight_uid)), flight_uid)
  from fx_stg where flight_date >= date '1999-01-01') s
where rn <= (select least(sum(case when flight_date < date '1999-01-01' then 1 else 0 end),
                          sum(case when flight_date >= date '1999-01-01' then 1 else 0 end))
             from fx_stg)
group by side"""))
def q_equalised(spark, sf_dir):
    """OP-42: both sides cut to the smaller size in seeded order."""
    stg = written(fx_stg(spark, sf_dir).select("flight_uid", "flight_date"), "staging")
    ref = stg.filter(F.col("flight_date") < F.lit("1999-01-01").cast("date"))
    cur = stg.filter(F.col("flight_date") >= F.lit("1999-01-01").cast("date"))
    r, c = equalise(ref, cur, "flight_uid", (42, 24))

    def summ(df, side):
        return df.agg(F.count(F.lit(1)).alias("rows"), F.min("flight_uid").alias("min_uid"),
                      F.max("flight_uid").alias("max_uid")) \
            .select(F.lit(side).alias("side"), "rows", "min_uid", "max_uid")
    return summ(r, "reference").unionByName(summ(c, "current"))


@query("staged_downsample", with_fx(["fx_stg"], f"""
select flight_uid, flight_date from fx_stg
where {_unit(42)} < 0.5
  and ((select count(*) from fx_stg where {_unit(42)} < 0.5) < 10000 or {_unit(43)} < 0.5
       and ((select count(*) from fx_stg where {_unit(42)} < 0.5 and {_unit(43)} < 0.5) < 10000
            or {_unit(44)} < 0.5))"""))
def q_staged_downsample(spark, sf_dir):
    """OP-43: drop a fraction per stage until below the row budget."""
    return staged_downsample(fx_stg(spark, sf_dir).select("flight_uid", "flight_date"),
                             [0.5, 0.5, 0.5], 10_000, "flight_uid", 42)


@query("monthly_batches", with_fx(["fx_stg"], """
select cast(date_trunc('month', flight_date) as date) as batch_start,
       cast(date_trunc('month', flight_date) + interval 1 month as date) as batch_end,
       count(*) as flights, cast(sum(arr_del15) as bigint) as delayed,
       round(avg(arr_delay_minutes), 6) as avg_delay_minutes
from fx_stg group by 1, 2"""))
def q_monthly_batches(spark, sf_dir):
    """OP-44: every monthly batch's figures in a single grouped job."""
    return monthly_batches(fx_stg(spark, sf_dir), "flight_date", [
        F.count(F.lit(1)).alias("flights"),
        F.sum("arr_del15").cast("bigint").alias("delayed"),
        F.round(F.avg("arr_delay_minutes"), 6).alias("avg_delay_minutes")]) \
        .select("batch_start", "batch_end", "flights", "delayed", "avg_delay_minutes")
