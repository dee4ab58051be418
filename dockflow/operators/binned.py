"""Spark's regression trees grown by tasks that hold all rows, binned.

``GBTRegressor`` runs a job for every level of every tree: 300 trees of depth 8 are more than two thousand jobs, whatever the
rows. ``RandomForestRegressor`` sends the sums of every node of every tree through a shuffle and keeps all nodes on the driver.
After binning a row is one byte per feature, so a task holds them all: one grows the boosted trees in turn, many grow the trees
of a forest, and the nodes go from the tasks to the files of a saved model.

A frame of one partition is read row by row, with Spark's bins, random numbers and order of sums: the trees are those of
Spark's estimators. A larger frame is counted by bins and label first, so what a task holds is bounded by bins and labels,
not by rows; samples are then binomial or Poisson draws of those counts, and sums differ in their order.
"""

import json
import math
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.session import let_go
from dockflow.sources import sinks

U64 = 2**64 - 1
EPSILON = 2.0**-52
INVALID = -np.finfo(float).max  # the gain of a cut that is not allowed
LEAST_SAMPLE = 10_000  # rows that decide the bins of a larger table
TREES_PER_TASK = 5
BLOCK_ROWS = 65_536
DRAWN_ROWS = 250  # rows whose draws reach the driver at once: larger arrays would go to the old part of its heap


# --- Spark's random numbers ---


def _murmur3(data: bytes, seed: int) -> int:
    """Of eight bytes, as Scala's MurmurHash3.bytesHash."""
    h = seed
    for k in (int.from_bytes(data[:4], "little"), int.from_bytes(data[4:], "little")):
        k = k * 0xCC9E2D51 & 0xFFFFFFFF
        k = (k << 15 | k >> 17) & 0xFFFFFFFF
        h ^= k * 0x1B873593 & 0xFFFFFFFF
        h = (h << 13 | h >> 19) & 0xFFFFFFFF
        h = (h * 5 + 0xE6546B64) & 0xFFFFFFFF
    h ^= 8
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def xorshift_state(seed: int) -> int:
    """First state of Spark's XORShiftRandom."""
    data = (seed & U64).to_bytes(8, "big")
    low = _murmur3(data, 0x3C074A61)
    return _murmur3(data, low) << 32 | low


def xorshift_next(state):
    """The next state, of one generator or an array of them."""
    state = state ^ (state << 21 & U64) if isinstance(state, int) else state ^ (state << np.uint64(21))
    state = state ^ state >> (35 if isinstance(state, int) else np.uint64(35))
    return state ^ (state << 4 & U64) if isinstance(state, int) else state ^ (state << np.uint64(4))


def samples_of(n: int, seeds: list[int], share: float) -> np.ndarray:
    """Which of n rows each seed samples, one row per seed."""
    high, low, unit = np.uint64(2**26 - 1), np.uint64(2**27 - 1), 2.0**-53
    state = np.array([xorshift_state(s) for s in seeds], np.uint64)
    out = np.empty((n, len(seeds)), bool)
    for i in range(n):
        state = xorshift_next(state)
        first = state & high
        state = xorshift_next(state)
        out[i] = ((first << np.uint64(27)) + (state & low)) * unit < share
    return np.ascontiguousarray(out.T)


class JavaRandom:
    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & (2**48 - 1)

    def _next(self, bits: int) -> int:
        """Without a sign."""
        self.state = (self.state * 0x5DEECE66D + 0xB) & (2**48 - 1)
        return self.state >> 48 - bits

    def next_long(self) -> int:
        high, low = self._next(32), self._next(32)
        return (high << 32) + (low - 2**32 if low >= 2**31 else low) & U64

    def next_double(self) -> float:
        high, low = self._next(26), self._next(27)
        return ((high << 27) + low) * 2.0**-53

    def next_int(self, n: int) -> int:
        if n & -n == n:
            return n * self._next(31) >> 31
        while True:
            bits = self._next(31)
            if bits - bits % n + n - 1 < 2**31:
                return bits % n


def subset_of(n: int, k: int, seed: int) -> list[int]:
    """k of n features by reservoir sampling; the order decides between equal gains."""
    chosen, state = list(range(k)), xorshift_state(seed)
    for i in range(k, n):
        state = xorshift_next(state)
        first = state & 2**26 - 1
        state = xorshift_next(state)
        at = int(((first << 27) + (state & 2**27 - 1)) * 2.0**-53 * (i + 1))
        if at < k:
            chosen[at] = i
    return chosen


def bootstraps_of(spark: SparkSession, n: int, trees: int, rate: float, seed: int) -> np.ndarray:
    """How often each tree takes each of n rows, one row per tree: the draws that Spark makes for its first partition.

    The generator has no form that skips ahead, so the JVM draws.
    """
    drawn = spark._jvm.org.apache.commons.math3.distribution.PoissonDistribution(rate)
    drawn.reseedRandomGenerator(seed + 1)
    out = np.empty((n, trees), np.uint8)
    for i in range(0, n, DRAWN_ROWS):
        rows = min(DRAWN_ROWS, n - i)
        text = spark._jvm.java.util.Arrays.toString(drawn.sample(rows * trees))
        out[i : i + rows] = np.fromstring(text[1:-1], np.uint8, sep=",").reshape(rows, trees)
    return np.ascontiguousarray(out.T)


def features_per_node(strategy: str, n: int) -> int:
    named = {
        "all": n, "auto": n, "sqrt": math.ceil(math.sqrt(n)), "log2": max(1, math.ceil(math.log2(n))), "onethird": math.ceil(n / 3)
    }
    if strategy in named:
        return named[strategy]
    return min(n, int(strategy)) if strategy.isdigit() else math.ceil(float(strategy) * n)


# --- bins ---


def thresholds_of(values: np.ndarray, most: int, expected: float) -> list[float]:
    """Thresholds between the bins of one feature; zeros are those rows of the ``expected`` number that have no other value."""
    found, counts = np.unique(values[values != 0], return_counts=True)
    if not len(found):
        return []
    weights = dict(zip(found.tolist(), counts.astype(float).tolist(), strict=True))
    seen = float(counts.sum())
    if expected - seen > EPSILON * seen * 100:
        weights[0.0] = expected - seen
    points = sorted(weights.items())
    if len(points) - 1 <= most:
        return [(a + b) / 2.0 for (a, _), (b, _) in zip(points, points[1:], strict=False)]
    stride = target = expected / (most + 1)
    out, count = [], points[0][1]
    for (a, _), (b, more) in zip(points, points[1:], strict=False):
        before, count = count, count + more
        if abs(before - target) < abs(count - target):
            out.append((a + b) / 2.0)
            target += stride
    return out


def _thresholds(points: DataFrame, n: int, most_bins: int, seed: int) -> list[list[float]]:
    spark = points.sparkSession
    share = min(1.0, max(most_bins**2, LEAST_SAMPLE) / max(n, 1))
    if share < 1:
        drawn = xorshift_next(xorshift_state(seed)) & 2**32 - 1
        rows = points._jdf.javaRDD().sample(False, share, drawn - 2**32 if drawn >= 2**31 else drawn)
        points = DataFrame(spark._jsparkSession.createDataFrame(rows, points._jdf.schema()), spark)
    x = np.array([r["x"] for r in points.select("x").collect()])
    return [thresholds_of(column, min(most_bins, n) - 1, share * n) for column in x.T]


# --- trees ---


@dataclass
class _Node:
    stats: np.ndarray  # weight, sum and sum of squares of the labels
    impurity: float
    gain: float = -1.0
    feature: int = -1
    cut: int = -1
    left: "_Node | None" = None
    right: "_Node | None" = None

    @property
    def prediction(self) -> float:
        return float(self.stats[1] / self.stats[0]) if self.stats[0] else 0.0


def _impurity(w: np.ndarray, s: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Variance; 0 without rows."""
    n = np.where(w == 0, 1.0, w)
    return np.where(w == 0, 0.0, (q - (s * s) / n) / n)


def grow(
    bins: list[np.ndarray], widths: list[int], y: np.ndarray, w: np.ndarray, depth: int, least: int, least_gain: float,
    choose: Callable[[], list[int]],
) -> tuple[_Node, np.ndarray]:
    """The tree of rows with bins (an array per feature, of ``widths`` bins), labels and weights, and its prediction for each row.

    Nodes of a level are visited as Spark's stack gives them, since each draws its features (``choose``) in turn.
    """
    wy = w * y
    parts = (w, wy, wy * y)
    live = np.arange(len(y))  # rows in nodes that may still be cut
    at = np.zeros(len(y), np.int64)  # of those, their node in the level
    out = np.empty(len(y))
    root = _Node(np.array([p.sum() for p in parts]), 0.0)
    level = [root]
    for depth_here in range(depth + 1):
        if not level:
            break
        n = len(level)
        order = np.array([choose() for _ in level])
        gains = np.full((n, len(bins)), -np.inf)
        cuts = np.zeros((n, len(bins)), np.int64)
        lefts, totals = {}, {}
        for f, width in enumerate(widths):
            if width < 2:
                continue
            cell = at * width + bins[f][live]
            cum = np.stack([np.bincount(cell, p[live], n * width).reshape(n, width) for p in parts]).cumsum(2)
            lefts[f], totals[f] = cum[:, :, :-1], cum[:, :, -1:]
        if depth_here == 0:
            first = next((f for f in order[0] if f in lefts), None)
            if first is not None:
                left = lefts[first][:, 0, 0]
                root.stats = left + (totals[first][:, 0, 0] - left)
            root.impurity = float(_impurity(*root.stats))
        own = np.array([node.impurity for node in level])[:, None]
        for f, left in lefts.items():
            right = totals[f] - left
            both = left[0] + right[0]
            both = np.where(both == 0, 1.0, both)
            gain = own - left[0] / both * _impurity(*left) - right[0] / both * _impurity(*right)
            gain = np.where((left[0] < least) | (right[0] < least) | (gain < least_gain), INVALID, gain)
            cuts[:, f] = gain.argmax(1)
            gains[:, f] = gain[np.arange(n), cuts[:, f]]
        best = order[np.arange(n), np.take_along_axis(gains, order, 1).argmax(1)]
        following: list[_Node] = []
        for i, (node, f) in enumerate(zip(level, best.tolist(), strict=True)):
            gain = float(gains[i, f])
            if gain <= 0 or depth_here == depth:
                if gain <= INVALID:
                    node.impurity = -1.0
                continue
            node.gain, node.feature, node.cut = gain, f, int(cuts[i, f])
            left = lefts[f][:, i, node.cut]
            right = totals[f][:, i, 0] - left
            node.left, node.right = (_Node(s, float(_impurity(*s))) for s in (left, right))
            if depth_here + 1 < depth:
                following += [child for child in (node.left, node.right) if abs(child.impurity) >= EPSILON]
        following.reverse()
        place = {id(node): k for k, node in enumerate(following)}
        ends = [-1 if node.left is None else place.get(id(child), -1) for node in level for child in (node.left, node.right)]
        values = [(child or node).prediction for node in level for child in (node.left, node.right)]
        cut_by = np.array([node.feature for node in level])
        cut_at = np.array([node.cut for node in level])
        right = np.zeros(len(live), np.int64)
        for f in set(cut_by.tolist()) - {-1}:
            here = np.flatnonzero(cut_by[at] == f)
            right[here] = bins[f][live[here]] > cut_at[at[here]]
        side = 2 * at + right
        at = np.array(ends)[side]
        ended = at < 0
        out[live[ended]] = np.array(values)[side[ended]]
        live, at, level = live[~ended], at[~ended], following
    return root, out


def _pruned(node: _Node) -> _Node:
    """Without cuts between leaves of the same prediction."""
    if node.left is not None:
        left, right = node.left, node.right = _pruned(node.left), _pruned(node.right)
        if left.left is None and right.left is None and left.prediction == right.prediction:
            return _Node(node.stats, node.impurity)
    return node


def _rows(root: _Node, tree: int, thresholds: list[list[float]]) -> list[dict]:
    """A saved model's rows of a tree, nodes numbered in preorder."""
    out: list[dict] = []

    def add(node: _Node) -> int:
        row = {
            "tree": tree, "id": len(out), "prediction": node.prediction, "impurity": node.impurity, "stats": node.stats.tolist(),
            "gain": node.gain, "left": -1, "right": -1, "feature": node.feature, "threshold": None,
        }
        out.append(row)
        if node.left is not None:
            row["threshold"] = thresholds[node.feature][node.cut]
            row["left"], row["right"] = add(node.left), add(node.right)
        return row["id"]

    add(_pruned(root))
    return out


NODES = pa.schema(
    [
        ("tree", pa.int32()), ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()),
        ("stats", pa.list_(pa.float64())), ("gain", pa.float64()), ("left", pa.int32()), ("right", pa.int32()),
        ("feature", pa.int32()), ("threshold", pa.float64()),
    ]
)
NODES_SQL = (
    "tree int, id int, prediction double, impurity double, stats array<double>, gain double, `left` int, `right` int, "
    "feature int, threshold double"
)


def _binned(thresholds: list[list[float]]):
    """Bins of rows with features ``x``, a byte or two each, beside the label ``y``."""
    edges = [np.array(t) for t in thresholds]
    kind = np.uint8 if max(map(len, edges), default=0) < 256 else np.uint16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, len(edges))
            y = batch.column("y").to_numpy(zero_copy_only=False)
            if not (np.isfinite(x).all() and np.isfinite(y).all()):
                raise ValueError("features and labels must be numbers")
            bins = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], 1).astype(kind)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in bins], pa.binary()), batch.column("y")], ["bins", "y"])

    return run, kind


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Binned rows as blocks of bytes, numbered in their order."""
    table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
    for i in range(0, table.num_rows if table else 0, BLOCK_ROWS):
        part = table.slice(i, BLOCK_ROWS)
        y, n = (part.column(c).to_numpy().tobytes() for c in ("y", "n"))
        yield pa.RecordBatch.from_pydict({"block": [i // BLOCK_ROWS], "bins": [b"".join(part.column("bins").to_pylist())], "y": [y], "n": [n]}, BLOCKS)


BLOCKS = pa.schema([("block", pa.int32()), ("bins", pa.binary()), ("y", pa.binary()), ("n", pa.binary())])
BLOCKS_SQL = "block int, bins binary, y binary, n binary"


@dataclass(frozen=True)
class _Binned:
    """Rows (``bins``, ``y`` and their number ``n``) in one partition; ``single``: each row by itself, in the frame's order."""

    rows: DataFrame
    thresholds: list[list[float]]
    kind: type
    single: bool
    count: int

    @property
    def widths(self) -> list[int]:
        return [len(t) + 1 for t in self.thresholds]

    def columns(self, data: bytes) -> list[np.ndarray]:
        return [c.astype(np.int64) for c in np.frombuffer(data, self.kind).reshape(-1, len(self.thresholds)).T]


class _BinnedEstimator:
    """What both estimators share: rows to bins, nodes to a model of Spark's kind."""

    def _bin(self, dataset: DataFrame) -> _Binned:
        x = vector_to_array(F.col(self.getFeaturesCol())).alias("x")
        points = dataset.select(x, F.col(self.getLabelCol()).cast("double").alias("y"))
        n = points.count()
        if n == 0:
            raise ValueError("there are no rows to fit")
        thresholds = _thresholds(points, n, self.getMaxBins(), self.getSeed())
        place, kind = _binned(thresholds)
        binned = points.mapInArrow(place, "bins binary, y double")
        single = dataset.rdd.getNumPartitions() == 1
        if single:
            rows = binned.coalesce(1).withColumn("n", F.lit(1).cast("bigint"))
        else:
            rows = binned.groupBy("bins", "y").agg(F.count(F.lit(1)).alias("n")).repartition(1).sortWithinPartitions("bins", "y")
        return _Binned(rows, thresholds, kind, single, n)

    def _model(self, nodes: DataFrame, width: int, kind: type, weights: list[float]):
        """The trees in the files of a saved model, loaded from there; ``stored`` is their folder."""
        spark = nodes.sparkSession
        path = sinks.fresh_path(spark, "trees")
        split = F.struct(
            F.col("feature").alias("featureIndex"),
            F.when(F.col("threshold").isNull(), F.array().cast("array<double>")).otherwise(F.array("threshold")).alias("leftCategoriesOrThreshold"),
            F.lit(-1).alias("numCategories"),
        )
        node = F.struct(
            "id", "prediction", "impurity", F.col("stats").alias("impurityStats"), F.col("stats")[0].cast("bigint").alias("rawCount"),
            "gain", F.col("left").alias("leftChild"), F.col("right").alias("rightChild"), split.alias("split"),
        )
        sinks.write_table(nodes.select(F.col("tree").alias("treeID"), node.alias("nodeData")), f"{path}/data")

        given = {p.name: v for p, v in self._paramMap.items()}
        defaults = {p.name: v for p, v in self._defaultParamMap.items()}

        def saved(name: str, uid: str, names: set[str] | None = None, **more) -> str:
            kept = [{k: v for k, v in m.items() if names is None or k in names} for m in (given, defaults)]
            about = {"class": f"org.apache.spark.ml.regression.{name}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
            return json.dumps({**about, "uid": uid, "paramMap": kept[0], "defaultParamMap": kept[1], **more})

        rows = [(m, saved("DecisionTreeRegressionModel", f"{self.uid}_{m}", TREE_PARAMS), w) for m, w in enumerate(weights)]
        sinks.write_table(spark.createDataFrame(rows, "_1 int, _2 string, _3 double").coalesce(1), f"{path}/treesMetadata")
        whole = saved(kind.__name__, self.uid, numFeatures=width, numTrees=len(weights))
        spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
        let_go(spark)  # trees are read next, which take a good part of the driver's memory
        model = kind.load(path)
        model.stored = path
        return model


TREE_PARAMS = {"maxDepth", "minInstancesPerNode", "minInfoGain", "maxBins", "labelCol", "featuresCol", "predictionCol", "seed"}


class BinnedGBTRegressor(_BinnedEstimator, GBTRegressor):
    """``GBTRegressor`` for squared errors on rows without weights, in a few jobs."""

    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        binned = self._bin(dataset)
        nodes = binned.rows.mapInArrow(self._boosted(replace(binned, rows=None)), NODES_SQL)
        weights = [1.0] + [self.getStepSize()] * (self.getMaxIter() - 1)
        return self._model(nodes, len(binned.thresholds), GBTRegressionModel, weights)

    def _boosted(self, binned: _Binned):
        """A task that grows all trees of its rows."""
        width, rounds, seed, rate = len(binned.thresholds), self.getMaxIter(), self.getSeed(), self.getSubsamplingRate()
        depth, least, least_gain, step = self.getMaxDepth(), self.getMinInstancesPerNode(), self.getMinInfoGain(), self.getStepSize()
        chosen = features_per_node(self.getFeatureSubsetStrategy(), width)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
            if not table:
                return
            bins = binned.columns(b"".join(table.column("bins").to_pylist()))
            y, n = table.column("y").to_numpy(), table.column("n").to_numpy()
            if rate < 1 and binned.single:
                drawn = samples_of(len(y), [seed + m + 1 for m in range(rounds)], rate)
            p = np.zeros(len(y))
            for m in range(rounds):
                if rate == 1:
                    w = n
                elif binned.single:
                    w = drawn[m]
                else:
                    w = np.random.default_rng([seed & U64, m]).binomial(n, rate)
                random = JavaRandom(seed + m)
                choose = (lambda r=random: subset_of(width, chosen, r.next_long())) if chosen < width else (lambda: [*range(width)])
                labels = 2.0 * (y - p) if m else y
                root, values = grow(bins, binned.widths, labels, w.astype(float), depth, least, least_gain, choose)
                p = p + values * (step if m else 1.0)
                yield pa.RecordBatch.from_pylist(_rows(root, m, binned.thresholds), NODES)

        return run


class BinnedForestRegressor(_BinnedEstimator, RandomForestRegressor):
    """``RandomForestRegressor`` that offers every feature to every node, on rows without weights; tasks share out the trees."""

    def _fit(self, dataset: DataFrame) -> RandomForestRegressionModel:
        spark, binned, trees = dataset.sparkSession, self._bin(dataset), range(self.getNumTrees())
        if features_per_node(self.getFeatureSubsetStrategy(), len(binned.thresholds)) < len(binned.thresholds) or len(trees) < 2:
            raise ValueError("a forest of several trees with all features is grown here")
        if binned.single:
            drawn = bootstraps_of(spark, binned.count, len(trees), self.getSubsamplingRate(), self.getSeed())
        shares = [trees[i : i + TREES_PER_TASK] for i in range(0, len(trees), TREES_PER_TASK)]
        dealt = [([*share], [drawn[m].tobytes() for m in share] if binned.single else []) for share in shares]
        tasks = spark.createDataFrame(spark.sparkContext.parallelize(dealt, len(dealt)), "trees array<int>, weights array<binary>")
        blocks = binned.rows.mapInArrow(_packed, BLOCKS_SQL)
        nodes = tasks.crossJoin(F.broadcast(blocks)).mapInArrow(self._grown(replace(binned, rows=None)), NODES_SQL)
        return self._model(nodes, len(binned.thresholds), RandomForestRegressionModel, [1.0] * len(trees))

    def _grown(self, binned: _Binned):
        """A task that grows some trees; it holds all blocks of rows."""
        width, seed, rate = len(binned.thresholds), self.getSeed(), self.getSubsamplingRate()
        depth, least, least_gain = self.getMaxDepth(), self.getMinInstancesPerNode(), self.getMinInfoGain()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = sorted((r for batch in batches for r in batch.to_pylist()), key=lambda r: r["block"])
            if not rows:
                return
            bins = binned.columns(b"".join(r["bins"] for r in rows))
            y, n = np.frombuffer(b"".join(r["y"] for r in rows)), np.frombuffer(b"".join(r["n"] for r in rows), np.int64)
            for i, m in enumerate(rows[0]["trees"]):
                if binned.single:
                    w = np.frombuffer(rows[0]["weights"][i], np.uint8)
                else:
                    w = np.random.default_rng([seed & U64, m]).poisson(n * rate)
                root, _ = grow(bins, binned.widths, y, w.astype(float), depth, least, least_gain, lambda: [*range(width)])
                yield pa.RecordBatch.from_pylist(_rows(root, m, binned.thresholds), NODES)

        return run
