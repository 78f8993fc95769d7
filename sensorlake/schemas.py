"""Pinned schemas of the raw landing tables and of the published marts."""

from pyspark.sql import types as T

RAW_COUNTS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("location_id", T.LongType()),
        T.StructField("sensing_date", T.DateType()),
        T.StructField("hourday", T.LongType()),
        T.StructField("direction_1", T.LongType()),
        T.StructField("direction_2", T.LongType()),
        T.StructField("pedestriancount", T.LongType()),
        T.StructField("sensor_name", T.StringType()),
        T.StructField("month", T.StringType()),
    ]
)

RAW_SENSORS = T.StructType(
    [
        T.StructField("location_id", T.LongType()),
        T.StructField("sensor_description", T.StringType()),
        T.StructField("sensor_name", T.StringType()),
        T.StructField("installation_date", T.DateType()),
        T.StructField("location_type", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("direction_1", T.StringType()),
        T.StructField("direction_2", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)

# Grain of the hourly observation series used by the forecaster.
SERIES_KEYS = ["location_id", "sensing_date", "hour_of_day"]
TARGET = "pedestrian_count"
