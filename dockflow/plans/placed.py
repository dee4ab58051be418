"""The ride fact from one shuffle of rides, also where no table is small enough to be broadcast.

Rides are placed by day, as they are stored. What is joined to them goes to the same place: the stations that a day needs,
as start with their signals and as end, are a small table by day and station. So both joins and the write find their rows
together. A busy day is cut into pieces by ride, and its stations are given to every piece. A ride without an end station
lies with its day like any other, so there is no hot partition of missing ids.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.functions import rides as R
from dockflow.plans.enrich import SIGNALS, STATION_ROLE_COLUMNS, both_ends, station_rolling
from dockflow.plans.marts import FACT_COLUMNS
from dockflow.sources import sinks

RIDES_PER_PIECE = 500_000  # some 60 MB of fact
PLACE = ["hire_date", "piece"]


def pieces_by_day(daily: DataFrame, rides_per_piece: int = RIDES_PER_PIECE) -> dict:
    """How many pieces each day of the station-day table needs: one row per calendar day reaches the driver."""
    per_day = daily.groupBy("hire_date").agg(F.ceil(F.sum("total_departures") / rides_per_piece).alias("pieces"))
    return {r["hire_date"]: max(1, int(r["pieces"])) for r in per_day.collect()}


def _pieces(pieces: dict) -> Column:
    """The pieces of a row's day; days of one piece are not listed."""
    many = [F.lit(x) for day, n in sorted(pieces.items()) if n > 1 for x in (day, n)]
    return F.coalesce(F.create_map(*many)[F.col("hire_date")], F.lit(1)) if many else F.lit(1)


def _beside(spark: SparkSession) -> None:
    """Let rows that are placed by (day, piece) meet in a join that also asks for the station."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def _stations_of_days(banded: DataFrame, stations: DataFrame, pieces: dict) -> DataFrame:
    """Every station that a ride of the day starts or ends at, with its attributes, in every piece of the day."""
    seen = both_ends(banded, ["hire_date"]).select("hire_date", "station_id").filter("station_id IS NOT NULL").distinct()
    attributes = stations.select(F.col("station_id").alias("place_id"), *STATION_ROLE_COLUMNS)
    needed = seen.join(attributes, F.col("station_id") == F.col("place_id")).drop("place_id")
    return needed.withColumn("piece", F.explode(F.sequence(F.lit(0), _pieces(pieces) - 1)))


def placed_fact(
    banded: DataFrame, stations: DataFrame, daily: DataFrame, rides_per_piece: int = RIDES_PER_PIECE
) -> DataFrame:
    """The rows of ``marts.fact_rides``, partitioned by day and piece; ``daily`` should be stored.

    Sets ``spark.sql.requireAllClusterKeysForCoPartition`` to false, without which Spark would shuffle rides again for
    every join.
    """
    spark = banded.sparkSession
    _beside(spark)
    pieces = pieces_by_day(daily, rides_per_piece)
    partitions = max(1, sum(pieces.values()))
    piece = F.pmod(F.xxhash64("rental_id"), _pieces(pieces)).cast("int")
    rides = banded.withColumn("piece", piece).repartition(partitions, *PLACE)

    places = _stations_of_days(banded, stations, pieces)
    signals = station_rolling(daily).select("hire_date", "station_id", *SIGNALS)
    spread = signals.withColumn("piece", F.explode(F.sequence(F.lit(0), _pieces(pieces) - 1)))

    joined = rides
    for role in ("start", "end"):
        renamed = [F.col(c).alias(f"{role}_{out}") for c, out in STATION_ROLE_COLUMNS.items()]
        side = places.select(*[F.col(c).alias(f"{role}_{c}_") for c in [*PLACE, "station_id"]], *renamed)
        joined = _meet(joined, side, role, partitions)
    side = spread.select(*[F.col(c).alias(f"signal_{c}_") for c in [*PLACE, "station_id"]], *SIGNALS)
    joined = _meet(joined, side, "signal", partitions)
    defaults = {out: F.coalesce(F.col(name), F.lit(default)) for name, (out, default) in SIGNALS.items()}
    return joined.withColumns({"ride_sk": R.surrogate_key(F.col("rental_id")), **defaults}).select(*FACT_COLUMNS, "piece")


def _meet(rides: DataFrame, side: DataFrame, role: str, partitions: int) -> DataFrame:
    station = "end_station_id" if role == "end" else "start_station_id"
    here = side.repartition(partitions, *[F.col(f"{role}_{c}_") for c in PLACE])
    same = [F.col(c) == F.col(f"{role}_{c}_") for c in PLACE]
    return rides.join(here, [*same, F.col(station) == F.col(f"{role}_station_id_")], "left")


def write_placed_fact(fact: DataFrame, path: str) -> str:
    """Store the placed fact: it lies by day already, so it is sorted and written where it is."""
    return sinks.write_days(fact.drop("piece"), path)
