"""Flight-shaped views over the driver's tables.

``lineitem`` stands in for raw flights and ``events`` for the predictions
log; the mapping is fixed so that every registered query has an
ANSI-SQL twin (see :mod:`skydrift.plans.oracle`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skydrift.operators.staging import dedup_keep_first, quality_filter
from skydrift.sources.tables import read_table


def fx_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as raw flights, with NULLs and cancel flags derived from values."""
    return fx_raw_from(read_table(spark, sf_dir, "lineitem"))


def fx_raw_from(li: DataFrame) -> DataFrame:
    """The raw-flight projection of a lineitem frame (batch or stream)."""
    return li.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("_"),
                 F.col("l_linenumber").cast("string")).alias("flight_uid"),
        F.col("l_shipdate").cast("date").alias("flight_date"),
        F.nullif(F.col("l_suppkey"), F.lit(13)).alias("origin_airport_id"),
        (F.col("l_partkey") % 50).alias("dest_airport_id"),
        F.col("l_partkey").cast("string").alias("tail_number"),
        F.col("l_returnflag").alias("marketing_airline_network"),
        F.col("l_linestatus").alias("dep_time_blk"),
        ((F.col("l_partkey") % 24) * 100 + (F.col("l_suppkey") % 60)).alias("crs_dep_time"),
        F.nullif(F.col("l_quantity"), F.lit(7.0)).alias("crs_elapsed_time"),
        F.col("l_extendedprice").alias("distance"),
        (F.round(F.col("l_discount") * 1000) - 30).alias("arr_delay"),
        F.when(F.col("l_tax") < 0.005, F.lit(True))
         .when(F.col("l_tax") < 0.075, F.lit(False)).alias("cancelled"),
        F.floor(F.col("l_extendedprice") / 10000).cast("int").alias("distance_group"),
        F.col("l_linenumber").alias("flight_number_marketing_airline"),
        (F.col("l_orderkey") % 1000).alias("flight_number_operating_airline"),
        (((F.col("l_partkey") + 3) % 24) * 100).alias("crs_arr_time"),
        "l_partkey", "l_suppkey")


def calendar_and_targets(df: DataFrame) -> DataFrame:
    d = F.col("flight_date")
    return df.select(
        "flight_uid", "flight_date",
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.dayofmonth(d).alias("day_of_month"), (F.weekday(d) + 1).alias("day_of_week"),
        "origin_airport_id", "dest_airport_id", "tail_number",
        "marketing_airline_network", "dep_time_blk", "crs_dep_time",
        "crs_elapsed_time", "distance", "distance_group", "flight_number_marketing_airline",
        "flight_number_operating_airline", "crs_arr_time", "arr_delay",
        F.greatest(F.col("arr_delay"), F.lit(0.0)).alias("arr_delay_minutes"),
        F.when(F.col("arr_delay") > 15, 1).otherwise(0).alias("arr_del15"))


def fx_stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging view: quality filter -> keep-first dedup per uid -> calendar."""
    raw = fx_raw(spark, sf_dir)
    clean = quality_filter(raw, false_flags=["cancelled"], not_null=["origin_airport_id"],
                           positive=["distance"])
    first = dedup_keep_first(clean, "flight_uid",
                             ["marketing_airline_network", "l_partkey", "l_suppkey"])
    return calendar_and_targets(first)


def fx_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as the predictions log; ``props.k`` is the regression truth."""
    return fx_predictions_from(read_table(spark, sf_dir, "events"))


def fx_predictions_from(ev: DataFrame) -> DataFrame:
    k = F.get_json_object(F.col("props"), "$.k").cast("double")
    return ev.select(
        F.col("event_id").alias("id"), "ts",
        F.col("user_id").alias("origin_airport_id"),
        F.col("event_type").alias("marketing_airline_network"),
        F.col("value").alias("prediction_reg"),
        F.when(F.col("value") > 15, 1).otherwise(0).alias("prediction_class"),
        F.least(F.col("value") / 100.0, F.lit(1.0)).alias("prediction_class_proba"),
        k.alias("true_reg"),
        F.when(k > 50, 1).otherwise(0).alias("true_class"),
        F.col("props").alias("ground_truth"))


def fx_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Imbalanced binary pair: quality as truth, toxic as prediction."""
    lb = read_table(spark, sf_dir, "labels")
    return lb.select("doc_id", F.col("quality").alias("true_class"),
                     F.col("toxic").alias("prediction_class"))


def fx_raw_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem in the full 33-column raw flight layout (typed)."""
    li = read_table(spark, sf_dir, "lineitem")
    d = F.col("l_shipdate").cast("date")
    arr = F.round(F.col("l_discount") * 1000) - 30
    dep = arr - 5
    return li.select(
        F.year(d).alias("Year"), F.quarter(d).alias("Quarter"), F.month(d).alias("Month"),
        F.dayofmonth(d).alias("DayofMonth"), (F.weekday(d) + 1).alias("DayOfWeek"),
        d.alias("FlightDate"),
        F.when(F.col("l_suppkey") != 13, F.concat(F.lit("S"), F.col("l_suppkey").cast("string")))
         .alias("Origin"),
        F.concat(F.lit("City"), (F.col("l_suppkey") % 10).cast("string")).alias("OriginCityName"),
        F.lit("ST").alias("OriginState"), F.col("l_suppkey").cast("int").alias("OriginAirportID"),
        F.concat(F.lit("P"), (F.col("l_partkey") % 50).cast("string")).alias("Dest"),
        F.lit(None).cast("string").alias("DestCityName"), F.lit("DS").alias("DestState"),
        (F.col("l_partkey") % 50).cast("int").alias("DestAirportID"),
        F.floor("l_extendedprice").cast("int").alias("Distance"),
        F.floor(F.col("l_extendedprice") / 10000).cast("int").alias("DistanceGroup"),
        F.col("l_returnflag").alias("Marketing_Airline_Network"),
        F.col("l_linestatus").alias("Operating_Airline"),
        F.col("l_linenumber").alias("Flight_Number_Marketing_Airline"),
        (F.col("l_orderkey") % 1000).cast("int").alias("Flight_Number_Operating_Airline"),
        F.concat(F.lit("N"), F.col("l_partkey").cast("string")).alias("Tail_Number"),
        ((F.col("l_partkey") % 24) * 100 + F.col("l_suppkey") % 60).cast("int").alias("CRSDepTime"),
        (((F.col("l_partkey") + 3) % 24) * 100).cast("int").alias("CRSArrTime"),
        F.floor("l_quantity").cast("int").alias("CRSElapsedTime"),
        F.col("l_linestatus").alias("DepTimeBlk"),
        arr.alias("ArrDelay"), F.greatest(arr, F.lit(0.0)).alias("ArrDelayMinutes"),
        F.when(arr > 15, 1.0).otherwise(0.0).alias("ArrDel15"),
        F.floor(arr / 15).cast("double").alias("ArrivalDelayGroups"),
        dep.alias("DepDelay"), F.greatest(dep, F.lit(0.0)).alias("DepDelayMinutes"),
        F.when(F.col("l_tax") < 0.005, F.lit(True))
         .when(F.col("l_tax") < 0.075, F.lit(False)).alias("Cancelled"),
        (F.col("l_quantity") == 50).alias("Diverted"))
