"""Silhouette of weighted points by the distances of all pairs, in tiles of bounded size.

A point's silhouette compares its mean distance to its own cluster with that to the nearest other one. Equal rides are one
point with a weight, so the pairs are those of distinct points. Points are dealt into blocks; a task holds two blocks, takes
each distance once for both of its points and for all given clusterings, and only sums by point and cluster leave it.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockflow.operators.segments import SegmentSpec, moments
from dockflow.sources import sinks

BLOCK_POINTS = 4096
STRIP = 64  # points of a tile whose distances are held at once
SUMS = pa.schema([("block", pa.int32()), ("sums", pa.binary())])
VALUES = pa.schema([("clusters", pa.list_(pa.int32())), ("n_rides", pa.int64()), ("silhouettes", pa.list_(pa.float64()))])
Rides = list[dict[int, int]]  # of every clustering: rides by cluster


def _members(clusters: np.ndarray, n_rides: np.ndarray, rides: Rides) -> np.ndarray:
    """A row per point, a column per cluster of each clustering: the point's rides in its own clusters."""
    own = [(clusters[:, [i]] == np.array([*by], clusters.dtype)) * n_rides[:, None] for i, by in enumerate(rides)]
    return np.concatenate(own, 1).astype(float)


def _list(table: pa.Table, column: str) -> np.ndarray:
    """The one list of a one-row table."""
    return table.column(column).combine_chunks().flatten().to_numpy()


def _tile(rides: Rides, width: int):
    """Sums of distances from every point of a block to the clusters' rides in another, for both blocks of a tile."""

    def run(table: pa.Table) -> pa.Table:
        sides = {side: table.slice(i, 1) for i, side in enumerate(table.column("side").to_pylist())}
        here, there = sides["here"], sides["there"]
        a, b = (np.ascontiguousarray(_list(t, "z").reshape(-1, width).T) for t in (here, there))
        of_a, of_b = (_members(_list(t, "clusters").reshape(-1, len(rides)), _list(t, "n_rides"), rides) for t in (here, there))
        first, second = here.column("block")[0].as_py(), there.column("block")[0].as_py()
        sums_a, sums_b = np.empty_like(of_a), np.zeros_like(of_b)
        for k in range(0, len(of_a), STRIP):
            distance = np.zeros((min(STRIP, len(of_a) - k), len(of_b)))
            for x, y in zip(a, b, strict=True):
                away = x[k : k + STRIP, None] - y
                away *= away
                distance += away
            np.sqrt(distance, out=distance)
            sums_a[k : k + STRIP] = distance @ of_b
            if first != second:
                sums_b += distance.T @ of_a[k : k + STRIP]
        found = [(first, sums_a)] + [(second, sums_b)] * (first != second)
        return pa.Table.from_pydict({"block": [x for x, _ in found], "sums": [s.tobytes() for _, s in found]}, SUMS)

    return run


def _values(rides: Rides):
    """Silhouettes of a block's points from the sums of its tiles."""

    def run(sums: pa.Table, block: pa.Table) -> pa.Table:
        clusters, n_rides = _list(block, "clusters").reshape(-1, len(rides)), _list(block, "n_rides")
        reach = sum(np.frombuffer(s.as_py()) for s in sums.column("sums")).reshape(len(n_rides), -1)
        out, at = np.zeros(clusters.shape), 0
        for i, by in enumerate(rides):
            own = clusters[:, [i]] == np.array([*by], clusters.dtype)
            total, distance = np.array([*by.values()], float), reach[:, at : at + len(by)]
            at += len(by)
            others = (total * own).sum(1) - 1  # rides of the own cluster besides the point's first
            mean_own = (distance * own).sum(1) / np.where(others > 0, others, 1)
            mean_other = np.where(own, np.inf, distance / total).min(1)
            most = np.maximum(mean_own, mean_other)
            counts = (others > 0) & np.isfinite(mean_other) & (most > 0)
            out[counts, i] = (mean_other - mean_own)[counts] / most[counts]
        return pa.Table.from_pydict({"clusters": clusters.tolist(), "n_rides": n_rides, "silhouettes": out.tolist()}, VALUES)

    return run


def all_silhouettes(assigned: DataFrame, spec: SegmentSpec, columns: list[str], block_points: int = BLOCK_POINTS) -> DataFrame:
    """Distinct points (``n_rides``) with their clusters in every clustering (``columns``) and a silhouette for each.

    Distances are Euclidean over features in units of their deviation. A point counts as often as it has rides, its own
    copies at distance 0. The only ride of a cluster has silhouette 0, as has every point when there is one cluster.
    """
    spark = assigned.sparkSession
    scales = [deviation for _, deviation in moments(assigned, spec)]
    z = F.array(*[F.col(c) / F.lit(scale) for c, scale in zip(spec.features, scales)])
    clusters = F.array(*[F.col(c).cast("int") for c in columns])
    points = assigned.select(z.alias("z"), clusters.alias("clusters"), F.col("n_rides").cast("bigint").alias("n_rides"))
    blocks = max(1, -(-points.count() // block_points))
    dealt = F.pmod(F.xxhash64("z"), F.lit(blocks)).cast("int")
    one = F.sort_array(F.collect_list(F.struct("z", "clusters", "n_rides")))
    packed = points.groupBy(dealt.alias("block")).agg(one.alias("points"))
    path = sinks.write_table(packed, sinks.fresh_path(spark, "blocks"))
    stored = spark.read.schema(packed.schema).parquet(path)
    rides: Rides = [{} for _ in columns]
    each = stored.select(F.explode("points").alias("p")).select(F.posexplode("p.clusters").alias("i", "cluster"), "p.n_rides")
    for r in each.groupBy("i", "cluster").agg(F.sum("n_rides").alias("rides")).orderBy("i", "cluster").collect():
        rides[r["i"]][r["cluster"]] = r["rides"]

    arrays = stored.select(
        "block", F.flatten("points.z").alias("z"), F.flatten("points.clusters").alias("clusters"), F.col("points.n_rides").alias("n_rides")
    )
    after, before = F.sequence(F.col("block"), F.lit(blocks - 1)), F.sequence(F.lit(0), F.col("block"))
    here = arrays.select(F.col("block").alias("first"), F.explode(after).alias("second"), F.lit("here").alias("side"), arrays["*"])
    there = arrays.select(F.explode(before).alias("first"), F.col("block").alias("second"), F.lit("there").alias("side"), arrays["*"])
    # Blocks that no point was dealt to meet nobody.
    met = F.count(F.lit(1)).over(Window.partitionBy("first", "second")) == 2
    tiles = here.union(there).withColumn("met", met).filter("met").drop("met")
    sums = tiles.groupBy("first", "second").applyInArrow(_tile(rides, len(spec.features)), "block int, sums binary")
    return sums.groupBy("block").cogroup(arrays.groupBy("block")).applyInArrow(
        _values(rides), "clusters array<int>, n_rides bigint, silhouettes array<double>"
    )


def point_silhouettes(assigned: DataFrame, spec: SegmentSpec, block_points: int = BLOCK_POINTS) -> DataFrame:
    """Distinct points (``cluster``, ``n_rides``) with their ``silhouette``."""
    found = all_silhouettes(assigned, spec, ["cluster"], block_points)
    return found.select(F.col("clusters")[0].alias("cluster"), "n_rides", F.col("silhouettes")[0].alias("silhouette"))


def cluster_silhouettes(points: DataFrame) -> DataFrame:
    """Rides and mean silhouette of every cluster, and of all rides (``silhouette_all``)."""
    weighted = F.sum(F.col("silhouette") * F.col("n_rides"))
    by_cluster = points.groupBy("cluster").agg(
        F.sum("n_rides").alias("ride_count"), weighted.alias("weighted")
    )
    everything = Window.partitionBy()  # one row per cluster
    total = F.sum("weighted").over(everything) / F.sum("ride_count").over(everything)
    return by_cluster.select(
        "cluster", "ride_count", (F.col("weighted") / F.col("ride_count")).alias("silhouette"), total.alias("silhouette_all")
    )


def mean_silhouette(assigned: DataFrame, spec: SegmentSpec) -> float:
    """The mean over all rides, as a number: 0 without points."""
    return mean_silhouettes(assigned, spec, ["cluster"])[0]


def mean_silhouettes(assigned: DataFrame, spec: SegmentSpec, columns: list[str]) -> list[float]:
    """That of every clustering."""
    means = [F.sum(F.col("silhouettes")[i] * F.col("n_rides")) / F.sum("n_rides") for i in range(len(columns))]
    return [mean or 0.0 for mean in all_silhouettes(assigned, spec, columns).agg(*means).first()]
