import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dockflow.operators import quality, uniqueness
from tests.frames import values


def shuffled_bytes(frame):
    """Bytes that the exchanges of a frame's run have written."""
    frame.collect()
    total, todo = 0, [frame._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        if node.metrics().contains("shuffleBytesWritten"):
            total += node.metrics().apply("shuffleBytesWritten").value()
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.length()))
    return total


KEYS = {
    "dense": lambda r: [r.randint(0, 400) for _ in range(500)],
    "unique": lambda r: r.sample(range(-70_000, 70_000), 3000),
    "sparse": lambda r: [r.randint(-(2**62), 2**62) for _ in range(200)] * 2,
    "nulls": lambda r: [None if r.random() < 0.3 else r.randint(-5, 5) for _ in range(100)],
    "only nulls": lambda r: [None] * 4,
    "empty": lambda r: [],
}


@pytest.mark.parametrize("kind", KEYS)
def test_agrees_with_counting(spark, kind):
    keys = KEYS[kind](random.Random(2))
    frame = values(spark, "k", "bigint", keys).repartition(3)
    counts = Counter(k for k in keys if k is not None)
    assert uniqueness.surplus_rows(frame, "k").first()[0] == len(keys) - len(counts)
    assert quality.repeats(frame, "k").first()[0] == len(keys) - len(counts)
    found = {r["k"]: r["rows"] for r in uniqueness.repeated_keys(frame, "k").collect()}
    assert found == {k: n for k, n in counts.items() if n > 1}


def test_text_keys(spark):
    frame = values(spark, "k", "string", ["a", "b", "a", None])
    assert uniqueness.surplus_rows(frame, "k").first()[0] == 2
    assert [tuple(r) for r in uniqueness.repeated_keys(frame, "k").collect()] == [("a", 2)]


def test_unique_keys_move_less_than_a_tenth(spark, tmp_path):
    spark.range(0, 400_000, 1, 4).withColumnRenamed("id", "rental_id").write.parquet(str(tmp_path / "rides"))
    rides = spark.read.parquet(str(tmp_path / "rides"))
    rides = rides.withColumn("ride_sk", F.md5(F.col("rental_id").cast("string")))
    key = uniqueness.surrogate_or_number(rides, "ride_sk", "rental_id")
    assert key == "rental_id"
    plain = rides.groupBy("ride_sk").count().filter("count > 1")
    plain_number = rides.groupBy("rental_id").count().filter("count > 1")
    moved = shuffled_bytes(uniqueness.surplus_rows(rides, key))
    assert 0 < moved < shuffled_bytes(plain_number) / 10 < shuffled_bytes(plain) / 10
    assert shuffled_bytes(uniqueness.repeated_keys(rides, key)) < shuffled_bytes(plain_number) / 10


def test_a_broken_surrogate_is_checked_itself(spark):
    rides = spark.range(100).withColumnRenamed("id", "rental_id")
    broken = rides.withColumn("ride_sk", F.md5(F.greatest("rental_id", F.lit(1)).cast("string")))
    assert uniqueness.surrogate_or_number(broken, "ride_sk", "rental_id") == "ride_sk"
    assert uniqueness.repeated_keys(broken, "ride_sk").first()["rows"] == 2
    assert uniqueness.surrogate_or_number(rides, "ride_sk", "rental_id") == "ride_sk"
