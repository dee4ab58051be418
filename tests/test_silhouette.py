import numpy as np
import pytest

from dockflow.operators import segments, silhouette

SPEC = segments.SegmentSpec(("x", "y"), k=3)


def plain(rows):
    """Mean silhouette of single rides, by all pairs."""
    x = np.array([[r[0], r[1]] for r in rows for _ in range(r[3])])
    cluster = np.array([r[2] for r in rows for _ in range(r[3])])
    deviation = x.std(0)
    x = x / np.where(deviation == 0, 1, deviation)
    out = []
    for i in range(len(x)):
        distance = np.sqrt(((x - x[i]) ** 2).sum(1))
        own = cluster == cluster[i]
        others = [distance[cluster == c].mean() for c in set(cluster) - {cluster[i]}]
        if own.sum() < 2 or not others:
            out.append(0.0)
            continue
        a, b = distance[own].sum() / (own.sum() - 1), min(others)
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return cluster, np.array(out)


@pytest.mark.parametrize("block", [1, 7, 50, 2048])
def test_agrees_with_all_pairs(spark, block):
    rng = np.random.default_rng(4)
    seen = {}
    for _ in range(120):
        seen[(float(rng.integers(0, 30)), float(rng.integers(0, 4)))] = (int(rng.integers(0, 3)), int(rng.integers(1, 5)))
    rows = [(*k, *v) for k, v in seen.items()] + [(99.0, 99.0, 7, 1)]  # a cluster of one ride
    frame = spark.createDataFrame(rows, "x double, y double, cluster int, n_rides bigint")
    found = silhouette.cluster_silhouettes(silhouette.point_silhouettes(frame, SPEC, block)).collect()
    cluster, values = plain(rows)
    for r in found:
        assert r["ride_count"] == (cluster == r["cluster"]).sum()
        assert r["silhouette"] == pytest.approx(values[cluster == r["cluster"]].mean(), abs=1e-9)
        assert r["silhouette_all"] == pytest.approx(values.mean(), abs=1e-9)
    assert len(found) == 4


@pytest.mark.parametrize("rows", [[], [(1.0, 2.0, 0, 5)], [(1.0, 2.0, 0, 5), (2.0, 2.0, 0, 1)]])
def test_without_another_cluster_it_is_zero(spark, rows):
    frame = spark.createDataFrame(rows, "x double, y double, cluster int, n_rides bigint")
    assert silhouette.mean_silhouette(frame, SPEC) == 0.0
