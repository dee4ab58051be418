import numpy as np
import pytest

from dockflow.operators import segments, silhouette, starts
from tests.test_binned import jobs
from tests.test_silhouette import SPEC, plain


@pytest.mark.parametrize("block", [7, 30, 4096])
def test_several_clusterings_share_the_distances(spark, block):
    rng = np.random.default_rng(5)
    points = {(float(rng.integers(0, 40)), float(rng.integers(0, 4))): int(rng.integers(1, 5)) for _ in range(90)}
    rows = [(*at, n, *(int(rng.integers(0, k)) for k in (2, 3, 5)), 0) for at, n in points.items()]
    frame = spark.createDataFrame(rows, "x double, y double, n_rides bigint, a int, b int, c int, one int")
    columns = ["a", "b", "c", "one"]
    found = silhouette.all_silhouettes(frame, SPEC, columns, block).collect()
    assert sum(r["n_rides"] for r in found) == sum(points.values()) and len(found) == len(points)
    for i, column in enumerate(columns):
        _, values = plain([(r[0], r[1], r[3 + i], r[2]) for r in rows])
        weighted = sum(r["silhouettes"][i] * r["n_rides"] for r in found) / sum(points.values())
        assert weighted == pytest.approx(values.mean(), abs=1e-9)
    assert silhouette.mean_silhouettes(frame, SPEC, columns)[1] == pytest.approx(
        silhouette.mean_silhouette(frame.withColumnRenamed("b", "cluster"), SPEC), abs=1e-12
    )


def weighted(spark, n=400, parts=3):
    """Clumps of weighted points in some partitions."""
    rng = np.random.default_rng(6)
    rows = [(*(rng.integers(0, 4, 2) * 5 + rng.normal(size=2)).tolist(), int(rng.integers(1, 9))) for _ in range(n)]
    return spark.createDataFrame(rows, "x double, y double, n_rides bigint").repartition(parts).persist()


@pytest.mark.parametrize("parts", [1, 5])
def test_costs_of_starts_are_those_of_spark(spark, parts):
    scaled = segments.standardized(weighted(spark, parts=parts), SPEC).persist()
    wanted = [(k, seed) for k in (2, 5, 9) for seed in (42, 43, 44)]
    found = starts.costs(scaled, segments._kmeans(2, 42), wanted)
    for k, seed in wanted:
        assert found[k, seed] == pytest.approx(segments._kmeans(k, seed).fit(scaled).summary.trainingCost, rel=1e-10)


def test_the_best_start_is_taken_without_fitting_all(spark):
    scaled = segments.standardized(weighted(spark), SPEC).persist()
    spec = segments.SegmentSpec(SPEC.features, k=2, starts=5)
    models = segments.fit_each(scaled, spec, [3, 6])
    for k, model in zip((3, 6), models):
        best = segments.fit_best(scaled, segments.SegmentSpec(spec.features, k, spec.starts))
        assert model.summary.trainingCost == pytest.approx(best.summary.trainingCost, rel=1e-10)
    few, many = (segments.SegmentSpec(spec.features, 2, n) for n in (1, 5))
    more = jobs(spark, lambda: segments.fit_each(scaled, many, [6])) - jobs(spark, lambda: segments.fit_each(scaled, few, [6]))
    whole = jobs(spark, lambda: segments.fit_best(scaled, segments.SegmentSpec(spec.features, 6, 5)))
    assert more < whole / 3


def test_equal_points_and_fewer_than_clusters(spark):
    points = spark.createDataFrame([(1.0, 1.0, 3), (2.0, 1.0, 1)], "x double, y double, n_rides bigint")
    scan = segments.scan_k(points, segments.SegmentSpec(("x", "y"), k=2, starts=3), ks=[2, 3]).collect()
    assert [r["inertia"] for r in scan] == [0.0, 0.0] and [r["silhouette"] for r in scan] == pytest.approx([0.75, 0.75])
