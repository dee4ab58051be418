"""Exact uniqueness of numeric keys without moving every key.

Keys are set as bits: a bitmap of 32,768 neighbouring numbers is one row, built before anything is shuffled. A bitmap that
has fewer bits than its keys had rows holds repeats; only the keys of such bitmaps are grouped one by one.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPARSE = 512  # numbers a key: beyond it a bitmap would be larger than its keys
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _dense(table: DataFrame, key: str) -> bool:
    """Whether bitmaps are smaller than keys; reads the key column, moves one row."""
    if not isinstance(table.schema[key].dataType, WHOLE):
        return False
    low, high, n = table.agg(F.min(key), F.max(key), F.count(key)).first()
    return bool(n) and (high - low) / n < SPARSE


def _pages(table: DataFrame, key: str) -> DataFrame:
    """Per bitmap: rows, and distinct keys. Rows without a key are a page of no keys."""
    number = F.col(key).cast("bigint")
    bits = F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(number)))
    return table.groupBy(F.bitmap_bucket_number(number).alias("page")).agg(F.count(F.lit(1)).alias("rows"), bits.alias("keys"))


def surplus_rows(table: DataFrame, key: str) -> DataFrame:
    """One row, ``value``: rows minus distinct keys. NULL is not a key, so rows without one are all surplus."""
    if _dense(table, key):
        counted = _pages(table, key)
    else:
        counted = table.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
        counted = counted.withColumn("keys", F.col(key).isNotNull().cast("bigint"))
    return counted.agg(F.coalesce(F.sum(F.col("rows") - F.col("keys")), F.lit(0)).alias("value"))


def repeated_keys(table: DataFrame, key: str) -> DataFrame:
    """Every key that more than one row has, with the number of its rows: (key, rows)."""
    rows = table.filter(F.col(key).isNotNull())
    if _dense(table, key):
        crowded = _pages(table, key).filter("rows > keys").select("page")
        page = F.bitmap_bucket_number(F.col(key).cast("bigint"))
        rows = rows.select(F.col(key), page.alias("page")).join(crowded, "page", "left_semi")
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def stands_for(table: DataFrame, digest: str, number: str) -> bool:
    """Whether the digest of every row is the md5 of its number: then both repeat in the same rows. Moves at most one row."""
    differs = ~F.col(digest).eqNullSafe(F.md5(F.col(number).cast("string")))
    return table.filter(differs).limit(1).isEmpty()


def surrogate_or_number(table: DataFrame, surrogate: str, number: str) -> str:
    """The column to check a surrogate key by: its number where that decides it."""
    names = set(table.columns)
    return number if {surrogate, number} <= names and stands_for(table, surrogate, number) else surrogate
