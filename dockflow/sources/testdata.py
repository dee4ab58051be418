"""Raw ride and station tables derived from the given ``events`` and ``supplier`` tables.

The mapping is the one of FIXTURES.md section 3. It stays lazy: the supplier count is a scalar
subquery and the name lookups vanish from every plan that does not read a station name.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.sources import schemas

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
SUPPLIER = "s_suppkey bigint, s_name string"


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet")


def _suppliers(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SUPPLIER).parquet(f"{folder}/supplier.parquet")


def _ride_ids(events: DataFrame, suppliers: DataFrame) -> DataFrame:
    n = suppliers.agg(F.count(F.lit(1))).scalar()
    keys = events.selectExpr(
        "event_id",
        "event_type",
        "CAST(floor(value * 30) AS BIGINT) AS seconds",
        "date_trunc('second', CAST(ts AS TIMESTAMP)) AS ts0",
        "(user_id * 2) div 3 AS b",
        "CAST(get_json_object(props, '$.k') AS BIGINT) AS k",
    ).withColumn("n", n)
    return keys.selectExpr(
        "event_id AS rental_id",
        "seconds AS duration",
        "event_id % 997 AS bike_id",
        "timestampadd(SECOND, seconds, ts0) AS end_date",
        """CASE WHEN k % 50 = 0 THEN NULL
                WHEN event_type = 'signup' THEN (b * b) % n
                WHEN k >= 95 THEN (b + k) % n
                ELSE ((b + k) * (b + k)) % n END AS end_station_id""",
        "ts0 AS start_date",
        "(b * b) % n AS start_station_id",
    )


def _names(suppliers: DataFrame, prefix: str) -> DataFrame:
    # Grouping by the key lets the optimizer drop the lookup when the name is not used.
    return suppliers.groupBy(F.col("s_suppkey").alias(f"{prefix}_key")).agg(
        F.min("s_name").alias(f"{prefix}_station_name")
    )


def cycle_hire(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = _suppliers(spark, folder)
    rides = _ride_ids(_events(spark, folder), suppliers)
    start, end = _names(suppliers, "start"), _names(suppliers, "end")
    return (
        rides.join(start, F.expr("start_station_id = start_key"), "left")
        .join(end, F.expr("end_station_id = end_key"), "left")
        .select(*schemas.RIDES.fieldNames())
    )


def cycle_stations(spark: SparkSession, folder: str) -> DataFrame:
    return _suppliers(spark, folder).selectExpr(
        "s_suppkey AS id",
        "s_suppkey % 33 != 0 AS installed",
        "s_suppkey % 33 = 1 AS locked",
        "date_add(DATE '2010-01-01', CAST(s_suppkey * 13 % 1460 AS INT)) AS install_date",
        "s_name AS name",
        "lpad(CAST(s_suppkey AS STRING), 5, '0') AS terminal_name",
        """CASE WHEN s_suppkey % 97 = 96 THEN 52.0D
                ELSE (51450 + s_suppkey * 37 % 110) / 1000.0D END AS latitude""",
        "(s_suppkey * 53 % 260 - 230) / 1000.0D AS longitude",
        "CASE WHEN s_suppkey % 89 = 80 THEN 0L ELSE 10 + s_suppkey * 7 % 31 END AS docks_count",
        "s_suppkey % 20 = 0 AS temporary",
    )
