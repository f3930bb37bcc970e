"""Declared schemas: raw flights, staging, predictions log, runs, metrics."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw flight record's 33 column names and types, in file order.
RAW_FLIGHT_COLUMNS: list[tuple[str, str]] = [
    ("Year", "int"), ("Quarter", "int"), ("Month", "int"), ("DayofMonth", "int"),
    ("DayOfWeek", "int"), ("FlightDate", "date"),
    ("Origin", "string"), ("OriginCityName", "string"), ("OriginState", "string"),
    ("OriginAirportID", "int"),
    ("Dest", "string"), ("DestCityName", "string"), ("DestState", "string"),
    ("DestAirportID", "int"),
    ("Distance", "int"), ("DistanceGroup", "int"),
    ("Marketing_Airline_Network", "string"), ("Operating_Airline", "string"),
    ("Flight_Number_Marketing_Airline", "int"), ("Flight_Number_Operating_Airline", "int"),
    ("Tail_Number", "string"),
    ("CRSDepTime", "int"), ("CRSArrTime", "int"), ("CRSElapsedTime", "int"),
    ("DepTimeBlk", "string"),
    ("ArrDelay", "double"), ("ArrDelayMinutes", "double"), ("ArrDel15", "double"),
    ("ArrivalDelayGroups", "double"),
    ("DepDelay", "double"), ("DepDelayMinutes", "double"),
    ("Cancelled", "boolean"), ("Diverted", "boolean"),
]

# Raw name -> staging name, in staging column order (30 columns;
# DepDelay, DepDelayMinutes, Cancelled and Diverted are not carried over).
STAGING_RENAMES: list[tuple[str, str]] = [
    ("FlightDate", "flight_date"), ("Year", "year"), ("Quarter", "quarter"),
    ("Month", "month"), ("DayofMonth", "day_of_month"), ("DayOfWeek", "day_of_week"),
    ("Origin", "origin"), ("OriginCityName", "origin_city_name"),
    ("OriginState", "origin_state"), ("OriginAirportID", "origin_airport_id"),
    ("Dest", "dest"), ("DestCityName", "dest_city_name"), ("DestState", "dest_state"),
    ("DestAirportID", "dest_airport_id"), ("Distance", "distance"),
    ("DistanceGroup", "distance_group"),
    ("Marketing_Airline_Network", "marketing_airline_network"),
    ("Operating_Airline", "operating_airline"),
    ("Flight_Number_Marketing_Airline", "flight_number_marketing_airline"),
    ("Flight_Number_Operating_Airline", "flight_number_operating_airline"),
    ("Tail_Number", "tail_number"), ("CRSDepTime", "crs_dep_time"),
    ("CRSArrTime", "crs_arr_time"), ("CRSElapsedTime", "crs_elapsed_time"),
    ("DepTimeBlk", "dep_time_blk"), ("ArrDelay", "arr_delay"),
    ("ArrDelayMinutes", "arr_delay_minutes"), ("ArrDel15", "arr_del15"),
    ("ArrivalDelayGroups", "arrival_delay_groups"),
]

# Model feature groups of the default job configuration.
LOW_CARD_FEATURES = ["year", "quarter", "month", "day_of_month", "day_of_week",
                     "distance_group", "dep_time_blk"]
HIGH_CARD_FEATURES = ["origin_airport_id", "dest_airport_id",
                      "flight_number_marketing_airline",
                      "flight_number_operating_airline", "tail_number"]
CYCLIC_FEATURES = ["crs_dep_time", "crs_arr_time"]
NUMERIC_FEATURES = ["crs_elapsed_time"]
SKEWED_FEATURES = ["distance"]

# Targets and identifiers removed before a drift comparison.
DRIFT_DROP_COLUMNS = ["arr_delay_minutes", "arr_del15", "arr_delay", "dep_delay",
                      "dep_delay_minutes", "flight_uid", "flight_date"]


def _spark_type(name: str) -> T.DataType:
    return {"int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
            "string": T.StringType(), "date": T.DateType(),
            "boolean": T.BooleanType(), "timestamp": T.TimestampType()}[name]


def raw_text_schema() -> T.StructType:
    """All 33 raw columns as strings: the untyped staging read."""
    return T.StructType([T.StructField(n, T.StringType(), True)
                         for n, _ in RAW_FLIGHT_COLUMNS])


def raw_typed_schema() -> T.StructType:
    return T.StructType([T.StructField(n, _spark_type(t), True)
                         for n, t in RAW_FLIGHT_COLUMNS])


PREDICTIONS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("flight_uid", T.StringType(), True),
    T.StructField("input_features", T.StringType(), True),
    T.StructField("prediction_reg", T.DoubleType(), True),
    T.StructField("prediction_class", T.IntegerType(), True),
    T.StructField("model_version_reg", T.StringType(), True),
    T.StructField("model_version_class", T.StringType(), True),
    T.StructField("ground_truth", T.StringType(), True),
    T.StructField("prediction_class_proba", T.DoubleType(), True),
])
