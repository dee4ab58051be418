from random import Random

import pytest
from pyspark.sql import functions as F

from dockflow.llm import mixing
from tests.llm.frames import documents, empty, words


@pytest.mark.parametrize(
    ("sizes", "weights", "expected"),
    [
        ([100, 100, 100], [1, 1, 1], [100, 100, 100]),
        ([10, 1000, 1000], [5, 2, 1], [30, 1980 * 2 / 3, 1980 / 3]),
        ([10, 10, 1000], [5, 2, 1], [30, 30, 960]),
        ([0, 50], [5, 2], [0, 50]),
        ([0, 0], [1, 1], [0, 0]),
        ([], [], []),
    ],
)
def test_targets_fill_up_to_the_cap(sizes, weights, expected):
    assert mixing.targets(sizes, weights) == pytest.approx(expected)


def test_flight_keeps_words_and_documents():
    random = Random(5)
    sizes = [random.randint(0, 2000) for _ in range(500)]
    p = [random.random() for _ in range(500)]
    result = mixing.flight(p, sizes, random)
    assert sum(0 < x < 1 for x in result) <= 2
    assert sum(result) == pytest.approx(sum(p), abs=1e-5)
    assert sum(x * s for x, s in zip(result, sizes, strict=True)) == pytest.approx(sum(x * s for x, s in zip(p, sizes, strict=True)), rel=1e-6)
    landed = mixing.landing(result, sizes, p, random)
    assert set(landed) <= {0.0, 1.0}
    assert abs(sum((a - b) * s for a, b, s in zip(landed, p, sizes, strict=True))) <= 5


def test_inclusion_is_fair():
    taken = [0] * 6
    for seed in range(3000):
        for i, x in enumerate(mixing.flight([0.3] * 6, [5, 1, 7, 3, 9, 2], Random(seed))):
            taken[i] += x
    assert all(abs(t / 3000 - 0.3) < 0.03 for t in taken)


def test_every_source_comes_near_its_target(spark):
    rows = [(i, "w " * (1 + i * 7919 % 400), None if i % 3 == 0 else f"s{i % 7}", "en", 1) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, n_chars bigint").repartition(5)
    found = mixing.mixed(docs).cache()
    assert found.count() == 4000
    assert found.where("taken > 3 * size OR taken != copies * size").count() == 0
    by = found.groupBy("source", "source_size", "target").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
    for r in by.collect():
        assert r["source_size"] == r["size"] and abs(r["taken"] - r["target"]) <= 20, r
    again = {(r["doc_id"], r["taken"]) for r in mixing.mixed(docs).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in found.collect()}
    found.unpersist()


def test_many_levels_of_blocks(spark):
    rows = [(i, "s", 1 + i % 50, 0.37, i, 1) for i in range(3000)]
    units = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint, p double, digest bigint, row bigint")
    found = mixing.balanced(units, block_rows=16).collect()
    assert len(found) == 3000 and {r["p"] for r in found} == {0.0, 1.0}
    assert abs(sum(r["p"] * r["size"] for r in found) - 0.37 * sum(r["size"] for r in found)) <= 25
    assert abs(sum(r["p"] for r in found) - 0.37 * 3000) <= 3


def copied(rows):
    return sorted((r["doc_id"] or -1, r["size"], r["digest"], r["row"], r["copies"]) for r in rows)


def test_other_splits_give_the_same_mix(spark, tmp_path, monkeypatch):
    """Many blocks and levels, repeated rows, and the same files cut in other ways."""
    rows = [(i % 2500, "w " * (1 + i * 7919 % 300), f"s{i % 3}", "en", i % 2) for i in range(5000)]
    schema = "doc_id bigint, text string, source string, lang string, n_chars bigint"
    spark.createDataFrame(rows + rows[:700] * 2, schema).repartition(3).write.parquet(str(tmp_path / "docs"))
    original = mixing.balanced
    monkeypatch.setattr(mixing, "balanced", lambda units, seed: original(units, block_rows=64, seed=seed))
    results = []
    for size, partitions in (("128m", "4"), ("40k", "4"), ("9k", "13")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            docs = spark.read.parquet(str(tmp_path / "docs"))
            if partitions != "4":
                docs = docs.repartition(7)
            results.append(copied(mixing.mixed(docs).collect()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
            spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1] == results[2]
    assert len(results[0]) == 6400


def test_agrees_with_a_plain_version(spark):
    """Sizes, targets, flight and landing in plain Python, one block a source, compared row by row."""
    rows = [(i, "w " * (1 + i * 7919 % 400), None if i % 3 == 0 else f"s{i % 7}", "en", 1) for i in range(900)]
    rows += rows[:40] + [(None, "a b c", "s1", "en", 1), (5000, None, "s2", "en", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, n_chars bigint")
    found = mixing.mixed(docs).collect()
    sources = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    sizes = [sum(len(words(r[1])) for r in rows if r[2] == s) for s in sources]
    wanted = mixing.targets(sizes, [mixing.WEIGHTS[i % 3] for i in range(len(sources))])
    assert sum(wanted) == pytest.approx(sum(sizes))
    for source, size, target in zip(sources, sizes, wanted, strict=True):
        mine = [r for r in found if r["source"] == source]
        mine.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r["digest"], r["row"]))
        assert sorted(r["size"] for r in mine) == sorted(len(words(r[1])) for r in rows if r[2] == source)
        ratio = target / size
        p, own = [ratio - int(ratio)] * len(mine), [r["size"] for r in mine]
        random = mixing._seeded(42, 0, source, 0)
        expected = mixing.landing(mixing.flight(p, own, random), own, p, random)
        assert [r["copies"] for r in mine] == [int(ratio) + int(x) for x in expected]
        assert {(r["source_size"], r["target"]) for r in mine} == {(size, target)}
        assert all(r["taken"] == r["copies"] * r["size"] for r in mine)


def test_odd_documents(spark):
    docs = documents(spark)
    rows = mixing.mixed(docs).collect()
    assert len(rows) == docs.count()
    sizes = sorted(len(words(t["text"])) for t in docs.collect())
    assert sorted(r["size"] for r in rows) == sizes
    order = sorted({r["source"] for r in rows if r["source"] is not None})
    assert order == ["", "a", "b", "c", "d"]
    by_source = {r["source"]: (r["source_size"], r["target"]) for r in rows}
    expected = mixing.targets([by_source[s][0] for s in [*order, None]], [5, 2, 1, 5, 2, 1])
    assert [by_source[s][1] for s in [*order, None]] == pytest.approx(expected)


def test_documents_of_the_mix(spark):
    docs = documents(spark)
    copies = sum(r["copies"] for r in mixing.mixed(docs).collect())
    found = mixing.mixed_documents(docs)
    assert found.columns == docs.columns
    assert found.count() == copies


def test_empty_table(spark):
    assert mixing.mixed(empty(spark)).count() == 0
    assert mixing.mixed_documents(empty(spark)).count() == 0
