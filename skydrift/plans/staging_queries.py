"""Queries over the staging layer (OP-13, 15-17, 31, 98)."""

from __future__ import annotations

from pyspark.sql import functions as F

from skydrift.functions.exprs import flight_key
from skydrift.operators.monitor import table_summary
from skydrift.plans.oracle import with_fx
from skydrift.plans.registry import query
from skydrift.operators.staging import stage_flights
from skydrift.schemas import RAW_FLIGHT_COLUMNS, STAGING_RENAMES
from skydrift.sources.fixtures import fx_raw, fx_raw_flights, fx_stg


@query("stg_clean_dedup", with_fx(["fx_stg"], "select * from fx_stg"))
def stg_clean_dedup(spark, sf_dir):
    return fx_stg(spark, sf_dir)


@query("stg_monthly_delay", with_fx(["fx_stg"], """
select year, month,
       count(*) as flights,
       round(avg(arr_delay_minutes), 6) as avg_delay_minutes,
       round(avg(arr_del15), 6) as delay_rate,
       round(sum(distance), 2) as total_distance
from fx_stg group by year, month"""))
def stg_monthly_delay(spark, sf_dir):
    """Flagship: scan -> filter -> dedup -> calendar -> grouped rates."""
    return (fx_stg(spark, sf_dir)
            .groupBy("year", "month")
            .agg(F.count(F.lit(1)).alias("flights"),
                 F.round(F.avg("arr_delay_minutes"), 6).alias("avg_delay_minutes"),
                 F.round(F.avg("arr_del15"), 6).alias("delay_rate"),
                 F.round(F.sum("distance"), 2).alias("total_distance")))


@query("synthetic_key", with_fx(["fx_raw"], """
select flight_uid,
       concat_ws('_', coalesce(cast(origin_airport_id as varchar), 'NA'),
                      coalesce(cast(dest_airport_id as varchar), 'NA'),
                      coalesce(cast(flight_date as varchar), '00000000'),
                      coalesce(marketing_airline_network, 'NA'),
                      coalesce(cast(crs_dep_time as varchar), '0000')) as generated_key
from fx_raw"""))
def synthetic_key(spark, sf_dir):
    """OP-16 on every raw row (origin has NULLs -> default part)."""
    raw = fx_raw(spark, sf_dir)
    return raw.select("flight_uid", flight_key("origin_airport_id", "dest_airport_id",
                                               "flight_date", "marketing_airline_network",
                                               "crs_dep_time").alias("generated_key"))


@query("table_summary", with_fx(["fx_stg"], """
select 'fx_raw' as table_name, count(*) as row_count,
       min(flight_date) as min_date, max(flight_date) as max_date from fx_raw
union all
select 'fx_stg', count(*), min(flight_date), max(flight_date) from fx_stg"""))
def q_table_summary(spark, sf_dir):
    """OP-13 / OP-98: count, min and max date per table, one row each."""
    return table_summary({"fx_raw": fx_raw(spark, sf_dir), "fx_stg": fx_stg(spark, sf_dir)},
                         "flight_date")


_RAW_SQL = """raw AS (
  select cast(year(d) as integer) as Year, cast(quarter(d) as integer) as Quarter,
         cast(month(d) as integer) as Month, cast(day(d) as integer) as DayofMonth,
         cast(isodow(d) as integer) as DayOfWeek, d as FlightDate,
         case when l_suppkey <> 13 then 'S' || cast(l_suppkey as varchar) end as Origin,
         'City' || cast(l_suppkey % 10 as varchar) as OriginCityName, 'ST' as OriginState,
         cast(l_suppkey as integer) as OriginAirportID,
         'P' || cast(l_partkey % 50 as varchar) as Dest, cast(null as varchar) as DestCityName,
         'DS' as DestState, cast(l_partkey % 50 as integer) as DestAirportID,
         cast(floor(l_extendedprice) as integer) as Distance,
         cast(floor(l_extendedprice / 10000) as integer) as DistanceGroup,
         l_returnflag as Marketing_Airline_Network, l_linestatus as Operating_Airline,
         l_linenumber as Flight_Number_Marketing_Airline,
         cast(l_orderkey % 1000 as integer) as Flight_Number_Operating_Airline,
         'N' || cast(l_partkey as varchar) as Tail_Number,
         cast((l_partkey % 24) * 100 + l_suppkey % 60 as integer) as CRSDepTime,
         cast(((l_partkey + 3) % 24) * 100 as integer) as CRSArrTime,
         cast(floor(l_quantity) as integer) as CRSElapsedTime, l_linestatus as DepTimeBlk,
         arr as ArrDelay, greatest(arr, 0.0) as ArrDelayMinutes,
         case when arr > 15 then 1.0::double else 0.0::double end as ArrDel15,
         cast(floor(arr / 15) as double) as ArrivalDelayGroups,
         arr - 5 as DepDelay, greatest(arr - 5, 0.0) as DepDelayMinutes,
         case when l_tax < 0.005 then true when l_tax < 0.075 then false end as Cancelled,
         l_quantity = 50 as Diverted
  from (select *, cast(l_shipdate as date) as d, round(l_discount * 1000) - 30 as arr
        from lineitem) l)"""


def _stage_sql():
    names = [n for n, _ in RAW_FLIGHT_COLUMNS]
    order = ["Marketing_Airline_Network"] + [n for n in names if n != "Marketing_Airline_Network"]
    order_sql = ", ".join(f"{c} asc nulls last" for c in order)
    key = ("concat(coalesce(Origin, 'NA'), '_', coalesce(Dest, 'NA'), '_', "
           "coalesce(cast(FlightDate as varchar), '00000000'), '_', "
           "coalesce(Operating_Airline, 'NA'), '_', coalesce(cast(CRSDepTime as varchar), '0000'))")
    sel = ", ".join(f"{r} as {s}" for r, s in STAGING_RENAMES)
    return f"""select k as flight_uid, {sel} from (
  select *, row_number() over (partition by k order by {order_sql}) as rn
  from (select *, {key} as k from raw
        where Cancelled = false and Diverted = false and FlightDate is not null
          and Origin is not null and Dest is not null and ArrDelay is not null
          and ArrDelayMinutes is not null and ArrDel15 is not null and Distance > 0) b) q
where rn = 1"""


@query("stg_flights_from_raw", with_fx(["fx_raw"], _stage_sql(), _RAW_SQL))
def q_stage_from_raw(spark, sf_dir):
    """OP-15/16/17/31 on the full 33-column raw layout: quality filter,
    synthetic key with defaults, keep-first per key (airline asc nulls last,
    every other column as tie-break), 30-column rename."""
    return stage_flights(fx_raw_flights(spark, sf_dir))
