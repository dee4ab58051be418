import numpy as np
import pytest
from pyspark.sql import functions as F

from dockflow.operators import boosting

FEATURES = ["a", "b", "c", "d"]


def table(spark, n=2000, seed=1):
    rng = np.random.default_rng(seed)
    a, b, c, d = rng.integers(0, 24, n), rng.integers(0, 2, n), rng.normal(size=n).round(3), rng.integers(0, 300, n)
    y = (3 * np.sin(a / 4) + 2 * b * (c > 0) + d / 100 + rng.normal(0, 0.3, n)).round(2)
    rows = [tuple(map(float, r)) for r in zip(a, b, c, d, y, strict=True)]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, y double").repartition(3)


def plain_tree(x, g, columns, s, depth):
    """A tree as nested tuples by trying every cut of every column on the rows themselves."""
    total_g, total_h = g.sum(), float(len(g))
    best = (0.0, None)
    if depth:
        for f in columns:
            for cut in range(int(x[:, f].max(initial=0))):
                left = x[:, f] <= cut
                n = left.sum()
                if min(n, len(g) - n) < s.least_hessian:
                    continue
                gl, gr = g[left].sum(), g[~left].sum()
                gain = (gl**2 / (n + s.penalty) + gr**2 / (len(g) - n + s.penalty) - total_g**2 / (total_h + s.penalty)) / 2
                if gain > best[0] * (1 + 1e-9) + 1e-12:
                    best = (gain, (f, cut, left))
    if best[1] is None:
        return -s.step * total_g / (total_h + s.penalty)
    f, cut, left = best[1]
    return f, cut, plain_tree(x[left], g[left], columns, s, depth - 1), plain_tree(x[~left], g[~left], columns, s, depth - 1)


def plain_predict(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def same(tree, node, expected):
    if not isinstance(expected, tuple):
        assert tree.feature[node] == -1
        assert tree.value[node] == pytest.approx(expected, abs=1e-9)
        return
    assert (tree.feature[node], tree.cut[node]) == expected[:2]
    same(tree, 2 * node + 1, expected[2])
    same(tree, 2 * node + 2, expected[3])


def test_trees_equal_a_plain_version(spark):
    frame = table(spark)
    settings = boosting.BoostSettings(rounds=12, depth=4, step=0.3)
    model = boosting.fit(frame, FEATURES, "y", settings)
    rows = frame.select(*FEATURES, "y", F.xxhash64(*FEATURES, "y").alias("key")).toPandas()
    x = np.stack([np.searchsorted(e, rows[c].to_numpy(), "left") for c, e in zip(FEATURES, model.edges, strict=True)], 1)
    y, p = rows["y"].to_numpy(), np.full(len(rows), rows["y"].mean())
    assert model.base == pytest.approx(y.mean())
    for number, tree in enumerate(model.trees):
        used = boosting.sampled(rows["key"].to_numpy(), number, settings.rows, settings.seed)
        assert 0.75 < used.mean() < 0.85
        columns = boosting.columns_of(number, 4, settings.columns, settings.seed)
        assert len(columns) == 3
        expected = plain_tree(x[used], (p - y)[used], columns, settings, settings.depth)
        same(tree, 0, expected)
        p = p + np.array([plain_predict(expected, r) for r in x])
    assert np.allclose(model.predict(x.astype(np.uint8)), p)


def test_it_learns_and_is_kept(spark, tmp_path):
    frame = table(spark)
    model = boosting.fit(frame, FEATURES, "y", boosting.BoostSettings(rounds=25, depth=4, step=0.3))
    path = model.save(spark, str(tmp_path / "model.json"))
    again = boosting.BoostedModel.load(spark, path)
    assert again == model
    error = lambda m: m.transform(frame).agg(F.sqrt(F.avg((F.col("prediction") - F.col("y")) ** 2))).first()[0]
    spread = frame.agg(F.stddev_pop("y")).first()[0]
    assert error(again) < 0.25 * spread
    weights = {r["feature"]: r["importance"] for r in model.importances(spark).collect()}
    assert sum(weights.values()) == pytest.approx(1) and max(weights, key=weights.get) == "a"


def test_odd_tables(spark):
    none = table(spark).where("false")
    model = boosting.fit(none, FEATURES, "y", boosting.BoostSettings(rounds=2))
    assert (model.base, model.trees) == (0.0, [])
    few = spark.createDataFrame([(1.0, None, 2.0), (1.0, 5.0, 2.0), (None, 5.0, None)], "a double, b double, y double")
    model = boosting.fit(few, ["a", "b"], "y", boosting.BoostSettings(rounds=2))
    assert {r["prediction"] for r in model.transform(few).collect()} == {2.0}  # too few rows for any cut
