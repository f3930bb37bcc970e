"""ANSI-SQL twins (DuckDB dialect) of the registered queries.

The fixture views are inlined as CTEs; every computed column carries the
same alias as the Spark query, counts are BIGINT, sums DOUBLE.
"""

from __future__ import annotations

FX_RAW = """fx_raw AS (
  select concat(cast(l_orderkey as varchar), '_', cast(l_linenumber as varchar)) as flight_uid,
         cast(l_shipdate as date) as flight_date,
         nullif(l_suppkey, 13) as origin_airport_id,
         l_partkey % 50 as dest_airport_id,
         cast(l_partkey as varchar) as tail_number,
         l_returnflag as marketing_airline_network,
         l_linestatus as dep_time_blk,
         (l_partkey % 24) * 100 + (l_suppkey % 60) as crs_dep_time,
         nullif(l_quantity, 7.0) as crs_elapsed_time,
         l_extendedprice as distance,
         round(l_discount * 1000) - 30 as arr_delay,
         case when l_tax < 0.005 then true when l_tax < 0.075 then false else null end as cancelled,
         cast(floor(l_extendedprice / 10000) as integer) as distance_group,
         l_linenumber as flight_number_marketing_airline,
         l_orderkey % 1000 as flight_number_operating_airline,
         ((l_partkey + 3) % 24) * 100 as crs_arr_time,
         l_partkey, l_suppkey
  from lineitem)"""

FX_STG = """fx_stg AS (
  select flight_uid, flight_date,
         cast(year(flight_date) as integer) as year,
         cast(quarter(flight_date) as integer) as quarter,
         cast(month(flight_date) as integer) as month,
         cast(day(flight_date) as integer) as day_of_month,
         cast(isodow(flight_date) as integer) as day_of_week,
         origin_airport_id, dest_airport_id, tail_number, marketing_airline_network,
         dep_time_blk, crs_dep_time, crs_elapsed_time, distance, distance_group,
         flight_number_marketing_airline, flight_number_operating_airline, crs_arr_time, arr_delay,
         greatest(arr_delay, 0.0) as arr_delay_minutes,
         case when arr_delay > 15 then 1 else 0 end as arr_del15
  from (select *, row_number() over (partition by flight_uid
                 order by marketing_airline_network asc nulls last, l_partkey, l_suppkey) as rn
        from fx_raw
        where cancelled = false and origin_airport_id is not null and distance > 0) q
  where rn = 1)"""

FX_PREDICTIONS = """fx_predictions AS (
  select event_id as id, ts, user_id as origin_airport_id,
         event_type as marketing_airline_network,
         value as prediction_reg,
         case when value > 15 then 1 else 0 end as prediction_class,
         least(value / 100.0, 1.0) as prediction_class_proba,
         cast(json_extract_string(props, '$.k') as double) as true_reg,
         case when cast(json_extract_string(props, '$.k') as double) > 50 then 1 else 0 end as true_class,
         props as ground_truth
  from events)"""

FX_LABELS = """fx_labels AS (
  select doc_id, quality as true_class, toxic as prediction_class from labels)"""

_VIEWS = {"fx_raw": FX_RAW, "fx_stg": FX_STG, "fx_predictions": FX_PREDICTIONS,
          "fx_labels": FX_LABELS}
_DEPS = {"fx_stg": ["fx_raw"]}


def with_fx(views: list[str], body: str, ctes: str = "") -> str:
    """Prefix ``body`` with the fixture CTEs it needs (plus extra ``ctes``)."""
    order: list[str] = []
    for v in views:
        for d in _DEPS.get(v, []) + [v]:
            if d not in order:
                order.append(d)
    parts = [_VIEWS[v] for v in order]
    if ctes:
        parts.append(ctes.strip())
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
