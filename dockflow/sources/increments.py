"""Appending rides to a stored table so that each is kept once, whatever is delivered again or dies on the way.

The target lies by day, below it by load and batch; its key index and state files lie beside it. A batch is written in
this order: rides, keys, bookmark. Only the bookmark makes it visible.
"""


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.sources import bookmarks, readers, schemas, sinks
from dockflow.sources.keyindex import KeyIndex

KEY, DATETIME_KEY = "rental_id", "start_date"
TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"  # bookmarks compare as text


def key_index(spark: SparkSession, target: str, **sizes: int) -> KeyIndex:
    return KeyIndex(spark, f"{target.rstrip('/')}-keys", KEY, **sizes)


def one_delivery(rides: DataFrame) -> DataFrame:
    """One row per ride: of several deliveries in a batch the least, so that a second try takes the same."""
    rest = [c for c in schemas.RIDES.fieldNames() if c != KEY]
    least = rides.groupBy(KEY).agg(F.min(F.struct(*rest)).alias("least"))
    return least.select(KEY, *[F.col(f"least.{c}").alias(c) for c in rest]).select(*schemas.RIDES.fieldNames())


def append_batch(rides: DataFrame, target: str, load: str, batch_id: int, **sizes: int) -> bookmarks.Bookmark:
    """Append the rides that no committed batch holds. A batch that is committed already is left as it is.

    The batch is staged once. Its keys go through the index, so what is read of the target's keys follows the batch, not
    the target.
    """
    spark = rides.sparkSession
    mark = bookmarks.read(spark, target, load)
    if batch_id <= mark.batch_id:
        return mark
    sinks.remove_matching(spark, f"{target}/hire_date=*/load={load}/batch_id={batch_id}")  # of a try that died
    staged = f"{target.rstrip('/')}-staged/{load}/{batch_id}"
    one_delivery(rides).write.mode("overwrite").parquet(staged)
    fresh = spark.read.schema(schemas.RIDES).parquet(staged)
    high = fresh.agg(F.date_format(F.max(DATETIME_KEY), TEXT)).first()[0]  # the bookmark moves past repeats as well
    index, done = key_index(spark, target, **sizes), bookmarks.committed(spark, target)
    known = index.known(fresh.select(KEY), done)
    if known is not None:
        fresh = fresh.join(known, KEY, "left_anti").select(*schemas.RIDES.fieldNames())
    place = {"hire_date": F.to_date(DATETIME_KEY), "load": F.lit(load), "batch_id": F.lit(batch_id).cast("bigint")}
    placed = fresh.withColumns(place)
    placed.write.mode("append").partitionBy(*place).parquet(target)
    written = _stored(spark, target).filter((F.col("load") == load) & (F.col("batch_id") == batch_id))
    index.add(written.select(KEY), load, batch_id)
    mark = mark.after(batch_id, high, written.count())
    bookmarks.commit(spark, target, mark)
    sinks.remove(spark, staged)
    return mark


def _stored(spark: SparkSession, target: str) -> DataFrame:
    """Every stored ride with its load and batch, committed or not."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.RIDES)
    return spark.read.schema(f"{kinds}, hire_date date, load string, batch_id bigint").parquet(target)


def stored_rides(spark: SparkSession, target: str) -> DataFrame:
    """The rides of committed batches with their day, load and batch."""
    return _stored(spark, target).filter(bookmarks.committed(spark, target))


def loaded(spark: SparkSession, target: str) -> DataFrame:
    return stored_rides(spark, target).select(*schemas.RIDES.fieldNames())


def load_increment(
    table: DataFrame,
    target: str,
    load: str,
    start: Column | None = None,
    until: Column | None = None,
    **sizes: int,
) -> bookmarks.Bookmark:
    """One run of a bookmarked load: the rides from the bookmark on, up to ``until`` when given.

    The bookmark itself is included, since rides of the same moment may have come later; what is stored already is
    dropped by the index. The first run begins at ``start``.
    """
    spark = table.sparkSession
    mark = bookmarks.read(spark, target, load)
    since = start if mark.high_water is None else F.to_timestamp(F.lit(mark.high_water), TEXT)
    rows = table if since is None else table.filter(F.col(DATETIME_KEY) >= since)
    rows = rows if until is None else rows.filter(F.col(DATETIME_KEY) <= until)
    return append_batch(readers.extract(rows, schemas.RIDES.fieldNames()), target, load, mark.batch_id + 1, **sizes)


def load_history(spark: SparkSession, target: str) -> DataFrame:
    """Rides and span of every committed batch."""
    return (
        stored_rides(spark, target)
        .groupBy("load", "batch_id")
        .agg(
            F.count(F.lit(1)).alias("rides"),
            F.min(DATETIME_KEY).alias("first_start"),
            F.max(DATETIME_KEY).alias("last_start"),
        )
    )
