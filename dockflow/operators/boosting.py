"""Gradient boosting of second order with histogram trees.

A round fits a tree to the gradients and Hessians of the squared error. For every level tasks sum both by node, feature and
bin, the sums are added up by node, and the best cut of each node follows from them: cuts maximise the gain of second order,
leaves are -G / (H + penalty), shrunk. Each tree has its own sample of rows and of columns. Rows keep their predictions in
a stored table that is renewed every few trees, so a task evaluates those few trees only.
"""

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.sources import sinks

BINS = 256
RENEW = 10  # trees between two stored tables of predictions
DIGITS = 10  # of a gain that decide; the rest is the order of a sum


@dataclass(frozen=True)
class BoostSettings:
    rounds: int = 300
    depth: int = 8
    step: float = 0.05
    rows: float = 0.8
    columns: float = 0.8
    least_hessian: float = 5.0
    penalty: float = 1.0
    seed: int = 42


@dataclass
class Tree:
    """Nodes in heap order: children of i are 2i+1 and 2i+2. A node without a feature (-1) is a leaf."""

    feature: list[int]
    cut: list[int]
    value: list[float]

    @classmethod
    def empty(cls, depth: int) -> "Tree":
        n = 2 ** (depth + 1) - 1
        return cls([-1] * n, [0] * n, [0.0] * n)

    def place(self, bins: np.ndarray) -> np.ndarray:
        """The node where each row ends."""
        feature, cut = np.array(self.feature), np.array(self.cut)
        node, rows = np.zeros(len(bins), dtype=np.int64), np.arange(len(bins))
        while True:
            f = feature[node]
            inner = f >= 0
            if not inner.any():
                return node
            right = bins[rows, np.maximum(f, 0)] > cut[node]
            node = np.where(inner, 2 * node + 1 + right, node)

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.place(bins)]


@dataclass
class BoostedModel:
    features: list[str]
    edges: list[list[float]]
    base: float
    trees: list[Tree]
    gains: list[float]  # summed gain of each feature's cuts

    def binned(self, batch: pa.RecordBatch) -> np.ndarray:
        """Bins of the features; a missing value is the smallest."""
        out = np.empty((batch.num_rows, len(self.features)), dtype=np.uint8)
        for i, (name, edges) in enumerate(zip(self.features, self.edges, strict=True)):
            values = np.nan_to_num(batch.column(name).to_numpy(zero_copy_only=False).astype(float), nan=-np.inf)
            out[:, i] = np.searchsorted(np.array(edges), values, "left")
        return out

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return sum((t.predict(bins) for t in self.trees), np.full(len(bins), self.base))

    def transform(self, table: DataFrame) -> DataFrame:
        """The table with a column ``prediction``."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.append_column("prediction", pa.array(self.predict(self.binned(batch))))

        numbers = {c: F.col(c).cast("double") for c in self.features}
        schema = table.withColumns(numbers).withColumn("prediction", F.lit(0.0)).schema
        return table.withColumns(numbers).mapInArrow(run, schema)

    def importances(self, spark: SparkSession) -> DataFrame:
        total = sum(self.gains) or 1.0
        rows = [(name, gain / total) for name, gain in zip(self.features, self.gains, strict=True)]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"))

    def save(self, spark: SparkSession, path: str) -> str:
        sinks.point(spark, path, json.dumps(asdict(self)))
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "BoostedModel":
        found = json.loads(sinks.pointed(spark, path))
        return cls(**{**found, "trees": [Tree(**t) for t in found["trees"]]})


def edges_of(table: DataFrame, features: list[str]) -> list[list[float]]:
    """Upper ends of all bins but the last: up to 255 quantiles of each feature."""
    steps = F.array(*[F.lit(i / (BINS - 1)) for i in range(BINS)])
    row = table.agg(*[F.percentile_approx(F.col(c).cast("double"), steps, 10_000) for c in features]).first()
    return [sorted(set(found or ()))[:-1] for found in row]


def sampled(key: np.ndarray, tree: int, share: float, seed: int) -> np.ndarray:
    """Rows of a tree: by a mix of the row's key and the tree's number, the same on every run."""
    x = key.astype(np.uint64) ^ np.uint64((tree * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x >> np.uint64(11)).astype(float) / 2**53 < share


def columns_of(tree: int, n: int, share: float, seed: int) -> list[int]:
    rng = np.random.default_rng([seed, tree])
    return sorted(rng.choice(n, max(1, int(share * n)), replace=False).tolist())


def best_cut(sums: np.ndarray, columns: list[int], settings: BoostSettings) -> tuple[float, int, int, float]:
    """(gain, feature, cut, leaf) of a node from its sums of gradients and Hessians by feature and bin."""
    total_g, total_h = sums[0].sum(0)
    left = sums.cumsum(1)[:, :-1]
    g, h = left[..., 0], left[..., 1]
    score = lambda a, b: a * a / (b + settings.penalty)
    gain = (score(g, h) + score(total_g - g, total_h - h) - score(total_g, total_h)) / 2
    allowed = (h >= settings.least_hessian) & (total_h - h >= settings.least_hessian)
    gain = np.where(allowed, gain, 0.0)
    most = float(gain.max(initial=0.0))
    leaf = -settings.step * total_g / (total_h + settings.penalty)
    if most <= 1e-12:
        return 0.0, -1, 0, leaf
    near = gain >= most * (1 - 10.0**-DIGITS)  # equal gains: the first feature and cut
    f, cut = np.argwhere(near)[0]
    return most, columns[f], int(cut), leaf


STATE = "bins binary, y double, key bigint, p double"


def _state(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, ...]:
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, width)
    return bins, batch.column("y").to_numpy(), batch.column("key").to_numpy(), batch.column("p").to_numpy()


def _sums(recent: list[Tree], tree: Tree, number: int, active: list[int], columns: list[int], width: int, settings: BoostSettings):
    """Tasks' sums of gradients and Hessians of the active nodes, one row per node."""
    place_of = np.full(len(tree.feature), -1)
    place_of[active] = np.arange(len(active))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(active), len(columns), BINS, 2))
        for batch in batches:
            bins, y, key, p = _state(batch, width)
            here = place_of[tree.place(bins)]
            used = (here >= 0) & sampled(key, number, settings.rows, settings.seed)
            bins, here = bins[used], here[used]
            g = sum((t.predict(bins) for t in recent), p[used]) - y[used]
            for i, f in enumerate(columns):
                cell = here * BINS + bins[:, f]
                total[:, i, :, 0] += np.bincount(cell, g, len(active) * BINS).reshape(-1, BINS)
                total[:, i, :, 1] += np.bincount(cell, minlength=len(active) * BINS).reshape(-1, BINS)
        yield pa.RecordBatch.from_arrays([pa.array(active), pa.array([t.tobytes() for t in total])], ["node", "sums"])

    return run


def _cuts(columns: list[int], settings: BoostSettings):
    """Add up a node's sums as they come, then its best cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for node, data in zip(batch.column("node").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                part = np.frombuffer(data).reshape(len(columns), BINS, 2)
                totals[node] = totals[node] + part if node in totals else part
        rows = [(node, *best_cut(total, columns, settings)) for node, total in totals.items()]
        names = ["node", "gain", "feature", "cut", "leaf"]
        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], _CUT)

    return run


_CUT = pa.schema([("node", pa.int64()), ("gain", pa.float64()), ("feature", pa.int32()), ("cut", pa.int32()), ("leaf", pa.float64())])
CUT = "node bigint, gain double, feature int, cut int, leaf double"


def fit(table: DataFrame, features: list[str], label: str, settings: BoostSettings | None = None) -> BoostedModel:
    """Fit on a table; what reaches the driver is one row per node of a level.

    Rows are known by a hash of their features and label, so equal rows are sampled together. Nulls are the smallest value.
    """
    settings = settings or BoostSettings()
    spark, width = table.sparkSession, len(features)
    base = table.agg(F.avg(label)).first()[0]
    model = BoostedModel(features, edges_of(table, features), float(base or 0.0), [], [0.0] * width)
    if base is None:
        return model

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = pa.array([row.tobytes() for row in model.binned(batch)], pa.binary())
            start = pa.array(np.full(batch.num_rows, model.base))
            yield pa.RecordBatch.from_arrays([bins, batch.column("y_"), batch.column("key_"), start], ["bins", "y", "key", "p"])

    numbers = [F.col(c).cast("double").alias(c) for c in features]
    y = F.col(label).cast("double")
    rows = table.filter(y.isNotNull()).select(*numbers, y.alias("y_"), F.xxhash64(*features, label).alias("key_"))
    state, path = _stored(rows.mapInArrow(begin, STATE))
    recent: list[Tree] = []
    for number in range(settings.rounds):
        columns = columns_of(number, width, settings.columns, settings.seed)
        tree, active = Tree.empty(settings.depth), [0]
        for level in range(settings.depth + 1):
            sums = state.mapInArrow(_sums(recent, tree, number, active, columns, width, settings), "node bigint, sums binary")
            found = sums.repartition("node").mapInArrow(_cuts(columns, settings), CUT).collect()
            active = []
            for r in found:
                tree.value[r["node"]] = r["leaf"]
                if level < settings.depth and r["feature"] >= 0:
                    tree.feature[r["node"]], tree.cut[r["node"]] = r["feature"], r["cut"]
                    model.gains[r["feature"]] += r["gain"]
                    active += [2 * r["node"] + 1, 2 * r["node"] + 2]
            if not active:
                break
            active.sort()
        model.trees.append(tree)
        recent.append(tree)
        if len(recent) == RENEW and number + 1 < settings.rounds:
            before = path
            state, path = _stored(state.mapInArrow(_renewed(recent, width), STATE))
            sinks.remove(spark, before)
            recent = []
    sinks.remove(spark, path)
    return model


def _renewed(recent: list[Tree], width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, _, _, p = _state(batch, width)
            yield batch.set_column(3, "p", pa.array(sum((t.predict(bins) for t in recent), p)))

    return run


def _stored(rows: DataFrame) -> tuple[DataFrame, str]:
    spark = rows.sparkSession
    path = sinks.write_table(rows, sinks.fresh_path(spark, "boosting"))
    return spark.read.schema(STATE).parquet(path), path
