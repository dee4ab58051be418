"""An index of the keys a table holds, so that a load reads few of them.

Keys lie in directories by hash bucket, below them by load and batch. Beside them lies a Bloom filter of every batch: the
hash space is cut into cells, and a cell's filter is one bitmap of 32,768 bits, built by Spark's bitmap aggregates. A batch
asks the filters first. Only keys that they may hold are looked for, and only in the buckets of these keys.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.sources import sinks

BITS = 32_768  # of one bitmap
PROBES = 6


@dataclass(frozen=True)
class KeyIndex:
    """``buckets`` directories of keys and ``cells`` filters; both are fixed when the index is first written.

    A cell holds up to about 2,000 keys well (sixteen bits a key, one key in a thousand is looked for in vain): 65,536
    cells suit a hundred million keys. More keys make the filters let more pass, never fewer.
    """

    spark: SparkSession
    path: str
    key: str
    buckets: int = 256
    cells: int = 65_536

    def _hash(self) -> Column:
        return F.xxhash64(self.key)

    def _bucket(self) -> Column:
        return F.pmod(self._hash(), F.lit(self.buckets)).cast("int").alias("bucket")

    def _probes(self, keys: DataFrame) -> DataFrame:
        """(key, cell, bit): the bits that a key sets in its cell's bitmap."""
        bits = F.array(*[F.pmod(F.xxhash64(F.lit(i), F.col(self.key)), F.lit(BITS)) for i in range(1, PROBES + 1)])
        cell = F.pmod(F.shiftright(self._hash(), 16), F.lit(self.cells)).cast("int")
        return keys.select(self.key, cell.alias("cell"), F.explode(bits).alias("bit"))

    def _table(self, name: str) -> str:
        return f"{self.path}/{name}"

    def add(self, keys: DataFrame, load: str, batch_id: int) -> None:
        """Add the keys of one batch; a second try of the same batch replaces the first."""
        self.remove(load, batch_id)
        place = {"load": F.lit(load), "batch_id": F.lit(batch_id).cast("bigint")}
        columns = ["bucket", "load", "batch_id"]
        (
            keys.select(self.key, self._bucket())
            .withColumns(place)
            .repartition("bucket")
            .write.mode("append")
            .partitionBy(*columns)
            .parquet(self._table("keys"))
        )
        (
            self._probes(keys)
            .groupBy("cell")
            .agg(F.bitmap_construct_agg("bit").alias("bits"))
            .withColumns(place)
            .write.mode("append")
            .partitionBy("load", "batch_id")
            .option("compression", "zstd")
            .parquet(self._table("filters"))
        )

    def remove(self, load: str, batch_id: int) -> None:
        for found in (f"keys/bucket=*/load={load}/batch_id={batch_id}", f"filters/load={load}/batch_id={batch_id}"):
            sinks.remove_matching(self.spark, self._table(found))

    def _read(self, name: str, columns: str) -> DataFrame | None:
        """A table of the index; None before anything is in it."""
        path = self._table(name)
        if not sinks.matching(self.spark, f"{path}/*=*"):
            return None
        return self.spark.read.schema(f"{columns}, load string, batch_id bigint").parquet(path)

    def suspects(self, keys: DataFrame, committed: Column) -> DataFrame | None:
        """The keys that the filters of committed batches may hold, with their buckets; all others are new."""
        filters = self._read("filters", "cell int, bits binary")
        if filters is None:
            return None
        merged = filters.filter(committed).groupBy("cell").agg(F.bitmap_or_agg("bits").alias("bits"))
        byte = "CAST(conv(hex(substr(bits, CAST(bit DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)"
        is_set = F.expr(f"(shiftright({byte}, CAST(bit % 8 AS INT)) & 1) = 1")
        tested = self._probes(keys).join(merged, "cell").withColumn("set", is_set)
        passed = tested.groupBy(self.key).agg(F.bool_and("set").alias("all")).filter("all")
        return passed.select(self.key, self._bucket())

    def stored_keys(self, buckets: list[int], committed: Column) -> DataFrame:
        """The committed keys of these buckets: other directories are not read."""
        kinds = f"{self.key} bigint, bucket int"
        return self._read("keys", kinds).filter(F.col("bucket").isin(buckets)).filter(committed).select(self.key)

    def known(self, keys: DataFrame, committed: Column) -> DataFrame | None:
        """Those of the keys that committed batches hold; None if there can't be any.

        ``keys`` is read twice, so it should be stored. The driver sees bucket numbers only.
        """
        suspects = self.suspects(keys, committed)
        if suspects is None:
            return None
        buckets = [r[0] for r in suspects.select("bucket").distinct().collect()]
        if not buckets:
            return None
        return suspects.select(self.key).join(self.stored_keys(buckets, committed), self.key, "left_semi")
