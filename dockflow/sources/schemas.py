"""Declared schemas of the raw tables. Nothing is inferred.

All names, types and their order are fixed values of the delivered tables.
"""

from pyspark.sql import types as T

RIDES = T.StructType(
    [
        T.StructField("rental_id", T.LongType(), False),
        T.StructField("duration", T.LongType()),
        T.StructField("bike_id", T.LongType()),
        T.StructField("end_date", T.TimestampType()),
        T.StructField("end_station_id", T.LongType()),
        T.StructField("end_station_name", T.StringType()),
        T.StructField("start_date", T.TimestampType(), False),
        T.StructField("start_station_id", T.LongType()),
        T.StructField("start_station_name", T.StringType()),
    ]
)

STATIONS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("installed", T.BooleanType()),
        T.StructField("locked", T.BooleanType()),
        T.StructField("install_date", T.DateType()),
        T.StructField("name", T.StringType()),
        T.StructField("terminal_name", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("docks_count", T.LongType()),
        T.StructField("temporary", T.BooleanType()),
    ]
)

# The dock column has a second name in delivered files.
STATION_ALIASES = {"nbdocks": "docks_count"}

# Columns that must be present in delivered files.
EXPECTED_COLUMNS = {
    "cycle_hire": [
        "rental_id",
        "bike_id",
        "duration",
        "start_date",
        "start_station_id",
        "start_station_name",
        "end_date",
        "end_station_id",
        "end_station_name",
    ],
    "cycle_stations": ["id", "name", "latitude", "longitude", "docks_count", "terminal_name"],
}
