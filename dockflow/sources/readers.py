"""Reading raw tables: declared schemas, pruned extracts, incremental windows, record validation."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockflow.sources import schemas
from dockflow.sources.literals import literal_rows

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def rename_aliases(stations: DataFrame) -> DataFrame:
    """Accept the second name of the dock column."""
    return stations.withColumnsRenamed(schemas.STATION_ALIASES)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .csv(path)
    )


def read_rides_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.RIDES)


def read_stations_csv(spark: SparkSession, path: str, dock_column: str = "docks_count") -> DataFrame:
    """``dock_column`` is the name in the file header; the result always says ``docks_count``."""
    fields = [
        T.StructField(dock_column, f.dataType, f.nullable) if f.name == "docks_count" else f
        for f in schemas.STATIONS
    ]
    return rename_aliases(read_csv(spark, path, T.StructType(fields)))


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def extract(table: DataFrame, columns: list[str]) -> DataFrame:
    """Only the listed columns; the scan reads nothing else."""
    return table.select(*columns)


def incremental(
    table: DataFrame, datetime_key: str, after: Column, until: Column | None = None
) -> DataFrame:
    """Rows newer than the saved high-water mark, up to and including ``until`` when given."""
    rows = table.filter(F.col(datetime_key) > after)
    return rows if until is None else rows.filter(F.col(datetime_key) <= until)


def high_water_mark(table: DataFrame, datetime_key: str) -> DataFrame:
    """The state to save after an incremental load: one row."""
    return table.agg(F.max(datetime_key).alias("high_water"))


def validate_records(feed: DataFrame, schema: T.StructType) -> DataFrame:
    """Type an all-text feed and name the first column that breaks the schema in ``rejected_for``.

    A value that does not parse, or a missing value in a required column, rejects the record.
    """
    typed = {f.name: F.try_to_timestamp(F.col(f.name)) if isinstance(f.dataType, T.TimestampType)
             else F.col(f.name).try_cast(f.dataType) for f in schema}
    broken = [
        F.when(
            (typed[f.name].isNull() & F.col(f.name).isNotNull())
            | (F.lit(not f.nullable) & F.col(f.name).isNull()),
            F.lit(f.name),
        )
        for f in schema
    ]
    return feed.select(
        *[typed[f.name].alias(f.name) for f in schema],
        *[F.col(f.name).alias(f"raw_{f.name}") for f in schema],
        F.coalesce(*broken).alias("rejected_for"),
    )


def accepted_records(validated: DataFrame, schema: T.StructType) -> DataFrame:
    return validated.filter(F.col("rejected_for").isNull()).select(*schema.fieldNames())


def rejected_records(validated: DataFrame, schema: T.StructType) -> DataFrame:
    """Rejects keep the delivered text, so that they can be repaired and sent again."""
    raw = [F.col(f"raw_{name}").alias(name) for name in schema.fieldNames()]
    return validated.filter(F.col("rejected_for").isNotNull()).select(*raw, "rejected_for")


def as_text(table: DataFrame) -> DataFrame:
    return table.select(*[F.col(c).cast("string").alias(c) for c in table.columns])


def filled_counts(table: DataFrame) -> DataFrame:
    """Number of values per column, from one pass: column_name, filled."""
    counts = table.agg(*[F.count(c).alias(c) for c in table.columns])
    return counts.unpivot([], counts.columns, "column_name", "filled")


def column_listing(table: DataFrame) -> DataFrame:
    """Name, type, position and number of values of every column."""
    rows = [(f.name, f.dataType.simpleString(), i) for i, f in enumerate(table.schema, 1)]
    names = ["column_name", "data_type", "ordinal_position"]
    listed = literal_rows(table.sparkSession, names, rows)
    return listed.join(filled_counts(table), "column_name").orderBy("ordinal_position")


def schema_presence(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per expected column: whether the table has it, and how many values it holds."""
    parts = []
    for name, table in tables.items():
        delivered = rename_aliases(table)
        rows = [(name, c, c in delivered.columns) for c in schemas.EXPECTED_COLUMNS[name]]
        expected = literal_rows(table.sparkSession, ["table_name", "column_name", "present"], rows)
        parts.append(expected.join(filled_counts(delivered), "column_name", "left"))
    out = reduce(DataFrame.union, parts)
    return out.select("table_name", "column_name", "present", F.coalesce("filled", F.lit(0)).alias("filled"))


def require_columns(name: str, table: DataFrame) -> None:
    missing = set(schemas.EXPECTED_COLUMNS[name]) - set(rename_aliases(table).columns)
    if missing:
        raise ValueError(f"{name} lacks columns: {sorted(missing)}")
