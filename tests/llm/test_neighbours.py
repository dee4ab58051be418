import numpy as np
import pytest
from pyspark.sql import functions as F

from dockflow.llm import neighbours

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, k, is_query):
    usable = []
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable.append((i, np.array(v, dtype=np.float32).astype(float)))
    lengths = [len(v) for _, v in usable]
    usual = min(set(lengths), key=lambda n: (-lengths.count(n), n), default=0)
    usable = [(i, v) for i, v in usable if len(v) == usual]
    found = {}
    for i, v in usable:
        if is_query(i):
            scored = {(-round(float(v @ w / np.sqrt((v @ v) * (w @ w))), 12), j) for j, w in usable if j != i}
            found[i] = sorted(scored)[:k]
    return found


def search(spark, rows, k=5, step=1, **how):
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"gid": F.lit(1), "list": F.lit("x"), "score": F.lit(0)})
    found = {}
    for r in neighbours.nearest(frame, F.col("vec_id") % step == 0, k=k, **how).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((-round(r["score"], 12), r["vec_id"]))
    return found


def test_odd_vectors_ties_and_copies(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0], 0), (2, [2.0, 0.0, 0.0], 0), (3, [1.0, 0.0, 0.0], 0), (3, [1.0, 0.0, 0.0], 0),
        (4, [0.0, 0.0, 0.0], 0), (5, None, 0), (6, [nan, 1.0, 0.0], 0), (7, [inf, 1.0, 0.0], 0), (8, [None, 1.0, 0.0], 0),
        (9, [1.0, 1.0], 0), (10, [], 0), (None, [1.0, 0.0, 0.0], 0), (11, [-1.0, 0.0, 0.0], None), (12, [0.5, 0.5, 0.0], 0),
    ]
    rows += [(100 + i, [0.0, 0.0, 1.0], 0) for i in range(20)]
    assert search(spark, rows, k=4) == plain(rows, 4, lambda i: True)


def test_small_tables_are_searched_whole(spark):
    random = np.random.default_rng(2)
    rows = [(i, random.normal(size=16).tolist(), 0) for i in range(120)]
    assert search(spark, rows, step=10) == plain(rows, 5, lambda i: i % 10 == 0)
    assert search(spark, rows[:3], step=1) == plain(rows[:3], 5, lambda i: True)
    assert search(spark, rows[:1], step=1) == {}


@pytest.mark.parametrize("block_rows", [50, 8192])
def test_recall_of_many_lists(spark, block_rows):
    random = np.random.default_rng(4)
    centres = random.normal(size=(40, 24))
    rows = [(i, (centres[i % 40] + 0.6 * random.normal(size=24)).tolist(), 0) for i in range(3000)]
    rows += [(3000 + i, rows[0][1], 0) for i in range(1500)]  # a third of all rows is one vector
    found = search(spark, rows, step=25, list_rows=32, block_rows=block_rows)
    expected = plain(rows, 5, lambda i: i % 25 == 0)
    assert set(found) == set(expected)
    hits = sum(len({j for _, j in found[q]} & {j for _, j in expected[q]}) for q in expected)
    assert hits >= 0.95 * sum(map(len, expected.values()))


def test_the_graph_finds_the_nearest_centroids():
    random = np.random.default_rng(7)
    points = neighbours.unit(random.normal(size=(2000, 32)))
    centroids = neighbours.graph_of(points, random)
    asked = neighbours.unit(random.normal(size=(200, 32)))
    ids, squared = centroids.search(asked, 32)
    true = np.argsort(neighbours._squared(asked, points), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) for a, b in zip(ids.tolist(), true.tolist(), strict=True)]) >= 9
    assert (np.diff(squared, axis=1) >= 0).all()
    assert all(len(set(row)) == len(row) for row in ids.tolist())


def test_lists_are_balanced():
    random = np.random.default_rng(8)
    crowded = np.concatenate([random.normal(size=(3000, 8)) * 0.05 + 1, random.normal(size=(1000, 8))])
    sample = neighbours.unit(crowded)
    centroids = neighbours.fit(sample, 40)
    sizes = np.bincount(centroids.search(sample, 1)[0][:, 0], minlength=40)
    assert sizes.max() <= 4 * sizes.mean()


def test_more_ties_than_neighbours(spark):
    """Different vectors of one direction tie with each other, and the smallest ids of them are returned."""
    rows = [(1000 - i, [float(2**(i % 20)) * (1 + i // 20), 0.0], 0) for i in range(60)] + [(5000, [1.0, 0.0], 0), (5001, [0.0, 1.0], 0)]
    found = search(spark, rows, step=1000)
    assert found[1000] == [(-1.0, 941 + i) for i in range(5)]


def test_border_vectors_only_are_posted_twice():
    points = np.array([[1, 0], [0.96, 0.28], [0, 1], [-1, 0]], dtype=np.float32)
    centroids = neighbours.graph_of(points, np.random.default_rng(1))
    x = neighbours.unit(np.array([[1, 0.01], [0.7, 0.72], [0.98, 0.14]]))
    ids, take = neighbours.post_lists(x, centroids, 1.6, 6)
    posts = [set(ids[i][take[i]].tolist()) for i in range(3)]
    assert posts == [{0}, {1, 2}, {0, 1}]


def test_repeats_go_before_the_window(spark):
    frame = spark.createDataFrame([(i % 3, [1.0, 0.0], 0) for i in range(300)], SCHEMA).select("vec_id", "embedding")
    found = neighbours.distinct_vectors(frame, 5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and [tuple(r["ids"]) for r in found.collect()] == [(0, 1, 2)]
