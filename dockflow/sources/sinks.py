"""Writing tables. Every writer returns the path it wrote."""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application that every executor can reach.

    It lies in the folder of ``spark.checkpoint.dir``, else in the warehouse folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/dockflow/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def copy(spark: SparkSession, path: str, target: str) -> None:
    """Copy a file or folder, which stays."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    source, fresh = hadoop.Path(path), hadoop.Path(target)
    hadoop.FileUtil.copy(source.getFileSystem(conf), source, fresh.getFileSystem(conf), fresh, False, conf)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match a pattern, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [f.getPath().toString() for f in found or ()]


def remove_matching(spark: SparkSession, pattern: str) -> None:
    for path in matching(spark, pattern):
        remove(spark, path)


def point(spark: SparkSession, pointer: str, path: str) -> None:
    """Make the file ``pointer`` hold the line ``path``, in one step for readers: a new file replaces it by a rename."""
    fs = spark._jvm.org.apache.hadoop.fs
    target, fresh = fs.Path(pointer), fs.Path(f"{pointer}.{uuid.uuid4().hex}")
    conf = spark._jsc.hadoopConfiguration()
    out = fresh.getFileSystem(conf).create(fresh, True)
    out.write(bytearray(path.encode()))
    out.close()
    options = spark._sc._gateway.new_array(getattr(fs, "Options$Rename"), 1)
    options[0] = getattr(fs, "Options$Rename").OVERWRITE
    context = fs.FileContext.getFileContext(target.getFileSystem(conf).getUri(), conf)
    context.rename(context.makeQualified(fresh), context.makeQualified(target), options)


def pointed(spark: SparkSession, pointer: str) -> str:
    return spark.read.text(pointer).first()[0]


def release(spark: SparkSession) -> None:
    """Remove every intermediate table of this application, once no result that reads one is in use."""
    remove(spark, shared_folder(spark))


def conform(table: DataFrame, schema: T.StructType) -> DataFrame:
    return table.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def with_load_metadata(table: DataFrame, version: int) -> DataFrame:
    """Load time, a sequence that is unique within the load, and the table version."""
    return table.select(
        "*",
        F.current_timestamp().alias("_sdc_received_at"),
        F.monotonically_increasing_id().alias("_sdc_sequence"),
        F.lit(version).cast("bigint").alias("_sdc_table_version"),
    )


def load_raw(table: DataFrame, schema: T.StructType, path: str, version: int = 1) -> str:
    """Replace a raw table by rows cast to the declared schema, plus load metadata."""
    with_load_metadata(conform(table, schema), version).write.mode("overwrite").parquet(path)
    return path


def z_value(first: Column, second: Column, bits: int = 20) -> Column:
    """The bits of two ids interleaved (Z-order): neighbours in it are neighbours in both. Missing ids come last.

    Ids from 0 to 2^bits - 2 keep their order; larger ones share the last place. ``bits`` is at most 31.
    """
    most = (1 << bits) - 1

    def spread(column: Column) -> Column:
        """The bits of a number, each followed by a zero, in five steps of shift and mask."""
        v = F.least(F.greatest(F.coalesce(column, F.lit(most)), F.lit(0)), F.lit(most)).cast("bigint")
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return F.shiftleft(spread(first), 1).bitwiseOR(spread(second))


def write_days(fact: DataFrame, path: str, max_records_per_file: int = 20_000_000) -> str:
    """One directory per day, rows of a day in Z-order of both stations, partitions as they are.

    Each row group then covers a small square of start and end stations, so a filter on either prunes most of them.
    """
    (
        fact.sortWithinPartitions("hire_date", z_value(F.col("start_station_id"), F.col("end_station_id")))
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy("hire_date")
        .parquet(path)
    )
    return path


def write_fact(fact: DataFrame, path: str, max_records_per_file: int = 20_000_000) -> str:
    """``write_days`` for a fact in any order.

    The rebalance hint hashes rows by day and lets adaptive execution cut a busy day into several
    tasks and put quiet days together, so no task holds a whole busy day.
    """
    return write_days(fact.hint("rebalance", F.col("hire_date")), path, max_records_per_file)


def write_table(table: DataFrame, path: str) -> str:
    table.write.mode("overwrite").parquet(path)
    return path


def read_fact(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The fact in its declared column order (directory columns come last on disk)."""
    return spark.read.parquet(path).select(*columns)


def write_csv(table: DataFrame, path: str) -> str:
    (
        table.write.mode("overwrite")
        .option("header", True)
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )
    return path


def write_json(table: DataFrame, path: str) -> str:
    table.write.mode("overwrite").json(path)
    return path
