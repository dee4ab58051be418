"""Published tables in the session catalog, so that SQL users find them and their columns are listed without reading data."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.plans.marts import FACT_COLUMNS
from dockflow.sources import sinks
from dockflow.sources.literals import literal_rows

PARTITIONED = {"fact_rides": "hire_date"}


def register_table(spark: SparkSession, name: str, path: str, columns: list[tuple[str, str]], day: str | None = None) -> None:
    """An external table over stored files; one that has the name already is replaced, its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    listed = ", ".join(f"`{c}` {kind}" for c, kind in columns)
    place = f" PARTITIONED BY ({day})" if day else ""
    spark.sql(f"CREATE TABLE {name} ({listed}) USING parquet{place} LOCATION '{path}'")
    if day:
        spark.catalog.recoverPartitions(name)


def register_run(spark: SparkSession, folder: str, pointer: str, database: str = "dockflow") -> list[str]:
    """Register the tables of the run that the pointer names; the names they have."""
    run = sinks.pointed(spark, f"{folder}/{pointer}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for table in ("int_station_daily_stats", "dim_date", "dim_stations", "fact_rides"):
        stored = spark.read.parquet(f"{run}/{table}")
        columns = FACT_COLUMNS if table == "fact_rides" else stored.columns
        kinds = dict(stored.dtypes)
        register_table(spark, f"{database}.{table}", f"{run}/{table}", [(c, kinds[c]) for c in columns], PARTITIONED.get(table))
        names.append(f"{database}.{table}")
    return names


def column_listing(spark: SparkSession, table: str) -> DataFrame:
    """Name, type and position of a table's columns, from the catalog alone; columns of its directories come last."""
    columns = spark.catalog.listColumns(table)
    ordered = [c for c in columns if not c.isPartition] + [c for c in columns if c.isPartition]
    rows = [(c.name, c.dataType, i) for i, c in enumerate(ordered, 1)]
    return literal_rows(spark, ["column_name", "data_type", "ordinal_position"], rows).orderBy("ordinal_position")


def described(spark: SparkSession, table: str) -> DataFrame:
    """The listing with the number of values of every column, which reads the table once."""
    counted = spark.table(table).agg(*[F.count(c).alias(c) for c in spark.table(table).columns])
    filled = counted.unpivot([], counted.columns, "column_name", "filled")
    return column_listing(spark, table).join(filled, "column_name").orderBy("ordinal_position")
