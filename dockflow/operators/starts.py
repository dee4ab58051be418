"""K-Means from many starts at once, to know which start ends at the least cost.

A fit of Spark runs some thirty jobs on a few megabytes of weighted points. Here every task holds all points and follows
some starts from Spark's first centres (k-means|| with its random numbers, then k-means++) to the end. The costs are those
of Spark's fits but for the order of sums, so only the best start is left to be fitted by Spark.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.operators.binned import JavaRandom, xorshift_next, xorshift_state

LOCAL_ROUNDS = 30  # of k-means++ among the candidates
BLOCKS = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("z", pa.binary()), ("w", pa.binary())])
COSTS = pa.schema([("k", pa.int32()), ("seed", pa.int64()), ("cost", pa.float64())])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    for i, batch in enumerate(batches):
        z, w = batch.column("z").flatten().to_numpy(), batch.column("w").to_numpy()
        yield pa.RecordBatch.from_pydict({"part": [part], "block": [i], "z": [z.tobytes()], "w": [w.tobytes()]}, BLOCKS)


def _distances(z: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, a row per point."""
    return np.stack([((z - c) ** 2).sum(1) for c in centres], 1)


def _draws(sizes: list[int], seed: int, step: int) -> np.ndarray:
    """A number from 0 to 1 for each point; every partition has its own generator."""
    high, low = np.uint64(2**26 - 1), np.uint64(2**27 - 1)
    state = np.array([xorshift_state(seed ^ step << 16 ^ i) for i in range(len(sizes))], np.uint64)
    out = np.empty((max(sizes), len(sizes)))
    for i in range(len(out)):
        state = xorshift_next(state)
        first = state & high
        state = xorshift_next(state)
        out[i] = ((first << np.uint64(27)) + (state & low)) * 2.0**-53
    return np.concatenate([out[:n, i] for i, n in enumerate(sizes)])


def _plus_plus(points: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """k centres of weighted candidates: k-means++, then rounds until nobody moves."""
    random = JavaRandom(0)

    def pick(scores: np.ndarray) -> int:
        """The first place at which the running sum reaches a drawn share of the whole."""
        return max(0, int(np.searchsorted(scores.cumsum(), random.next_double() * float(scores.sum()), "left")))

    centres = [points[min(pick(weights), len(points) - 1)]]
    cost = _distances(points, centres)[:, 0]
    for _ in range(1, k):
        centres.append(points[min(pick(weights * cost), len(points) - 1)])
        cost = np.minimum(cost, _distances(points, centres[-1:])[:, 0])
    centres, closest = np.array(centres), None
    for _ in range(LOCAL_ROUNDS):
        now = _distances(points, centres).argmin(1)
        if closest is not None and (now == closest).all():
            break
        closest = now
        for j in range(k):
            here = now == j
            centres[j] = (points[here] * weights[here, None]).sum(0) / weights[here].sum() if here.any() else points[random.next_int(len(points))]
    return centres


def first_centres(z: np.ndarray, sizes: list[int], first: np.ndarray, seed: int, k: int, steps: int) -> np.ndarray:
    """k-means||: in each step points are candidates by their cost, then k of the candidates by the points nearest to them."""
    candidates, new, cost = [first], [first], np.full(len(z), np.inf)
    for step in range(steps):
        if len(new):
            cost = np.minimum(cost, _distances(z, new).min(1))
        new = z[_draws(sizes, seed, step) < 2.0 * cost * k / cost.sum()] if cost.any() else z[:0]
        candidates += [*new]
    distinct = np.array([*dict.fromkeys(map(tuple, candidates))])
    if len(distinct) <= k:
        return distinct
    near = np.bincount(_distances(z, distinct).argmin(1), minlength=len(distinct))
    return _plus_plus(distinct, near.astype(float), k)


def cost_of(z: np.ndarray, w: np.ndarray, centres: np.ndarray, rounds: int, tolerance: float) -> float:
    """The cost of the last round, by the centres it began with."""
    cost = 0.0
    for _ in range(rounds):
        distance = _distances(z, centres)
        closest = distance.argmin(1)
        cost = float((distance[np.arange(len(z)), closest] * w).sum())
        weight = np.bincount(closest, w, len(centres))
        sums = np.stack([np.bincount(closest, c * w, len(centres)) for c in z.T], 1)
        new = np.where(weight[:, None] > 0, sums / np.where(weight > 0, weight, 1)[:, None], centres)
        still = (((new - centres) ** 2).sum(1) <= tolerance**2).all()
        centres = new
        if still:
            break
    return cost


def _followed(width: int, steps: int, rounds: int, tolerance: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in batch.to_pylist()]
        blocks = sorted({(r["part"], r["block"]): r for r in rows}.items())
        z = np.frombuffer(b"".join(r["z"] for _, r in blocks)).reshape(-1, width)
        w = np.frombuffer(b"".join(r["w"] for _, r in blocks))
        sizes = [0] * (blocks[-1][0][0] + 1 if blocks else 0)
        for (part, _), r in blocks:
            sizes[part] += len(r["w"]) // 8
        starts = {(r["k"], r["seed"]): r for r in rows}
        for (k, seed), r in starts.items():
            centres = first_centres(z, sizes, np.array(r["first"]), r["drawn"], k, steps)
            yield pa.RecordBatch.from_pydict({"k": [k], "seed": [seed], "cost": [cost_of(z, w, centres, rounds, tolerance)]}, COSTS)

    return run


def costs(scaled: DataFrame, kmeans: KMeans, starts: list[tuple[int, int]]) -> dict[tuple[int, int], float]:
    """The training cost of every start (k, seed) of an estimator on a stored frame of weighted points."""
    spark = scaled.sparkSession
    z, w = vector_to_array(F.col(kmeans.getFeaturesCol())).alias("z"), F.col(kmeans.getWeightCol()).cast("double").alias("w")
    points = scaled.select(z, w)
    rows, firsts = points._jdf.javaRDD(), {}
    for seed in {seed for _, seed in starts}:
        drawn = xorshift_next(xorshift_state(seed)) & 2**32 - 1
        drawn = drawn - 2**32 if drawn >= 2**31 else drawn
        found = DataFrame(spark._jsparkSession.createDataFrame(rows.takeSample(False, 1, drawn), points._jdf.schema()), spark).first()
        if found is None:
            raise ValueError("there are no points to cluster")
        firsts[seed] = found["z"], drawn
    width = len(next(iter(firsts.values()))[0])
    dealt = [(k, seed, *firsts[seed]) for k, seed in starts]
    tasks = spark.createDataFrame(spark.sparkContext.parallelize(dealt, len(dealt)), "k int, seed bigint, first array<double>, drawn int")
    blocks = points.mapInArrow(_packed, "part int, block int, z binary, w binary")
    run = _followed(width, kmeans.getInitSteps(), kmeans.getMaxIter(), kmeans.getTol())
    found = tasks.crossJoin(F.broadcast(blocks)).mapInArrow(run, "k int, seed bigint, cost double").collect()
    return {(r["k"], r["seed"]): r["cost"] for r in found}
