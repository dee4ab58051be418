"""Helpers shared by the operators: where intermediate tables go, and the connected components of links."""

import os
import uuid
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """A folder of its own for this application, where every executor reads and writes.

    It lies in the folder of ``spark.checkpoint.dir``; a session without one (as in tests) uses its warehouse folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/dockflow-llm/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written as a table in the shared folder and read again: lineage ends here, and it is computed once."""
    spark = frame.sparkSession
    path = fresh_path(spark, name)
    frame.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(frame.schema).parquet(path)
    table.stored_at = path  # for discard()
    return table


def discard(tables: Iterable[DataFrame]) -> None:
    """Delete stored tables that nothing needs any more."""
    for table in tables:
        if path := getattr(table, "stored_at", None):
            delete_path(table.sparkSession, path)


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Delete every intermediate table of this application; call it when no result of its operators is in use."""
    delete_path(spark, shared_folder(spark))


def importable(spark: SparkSession) -> None:
    """Let Python workers import this library from where it lies; a cluster without that folder takes --py-files."""
    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def unused(table: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of the table has them."""
    taken = {c.lower() for c in table.columns}
    made = []
    for name in names:
        while name in taken:
            name += "_"
        made.append(name)
    return made


def row_digest(table: DataFrame) -> Column:
    """A hash of all columns of a row (Spark hashes no maps, so those do not count)."""
    kinds = (f for f in table.schema if "map<" not in f.dataType.simpleString())
    return F.xxhash64(*[table[f.name] for f in kinds])


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the undirected links (a, b); root is the smallest node of its component.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): each round hangs nodes under the smallest
    neighbour, so the number of rounds grows with the logarithm of the component's width. A round is two grouped
    minima and two joins on a node; minima combine before the shuffle, and adaptive execution splits a hub's partition.
    The links of each round are a stored table, and the round before is deleted.
    """
    edges = stored(links.where("a != b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "links")
    mark = _fingerprint(edges)
    for _ in range(max_rounds):
        if mark[0] == 0:
            break
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").selectExpr("b AS a", "m AS b").distinct()
        large = stored(large, "large-star")
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(lowest, "a")
            .select(F.explode(F.expr("array(struct(b AS a, m AS b), struct(a AS a, m AS b))")).alias("e"))
            .select("e.a", "e.b")
            .where("a != b")
            .distinct()
        )
        after = stored(small, "small-star")
        discard([edges, large])
        edges, before, mark = after, mark, _fingerprint(after)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]
