import numpy as np
from pyspark.sql import functions as F

from dockflow.llm import quality
from tests.conftest import MEDIUM
from tests.llm.frames import documents, empty

RATINGS = "doc_id bigint, quality int, toxic int"


def test_grades(spark):
    rows = [(1, 1, 0), (1, 0, 0), (2, 1, 1), (3, None, None), (4, 0, None), (5, 1, None), (None, 1, 0), (6, None, 1), (7, 0, 1)]
    found = {r["doc_id"]: r["grade"] for r in quality.graded(spark.createDataFrame(rows, RATINGS)).collect()}
    assert found == {1: 1, 2: 0, 4: 1, 5: 2, 6: 0, 7: 0}


def test_thresholds_are_ordered_and_slopes_are_right():
    random = np.random.default_rng(1)
    rows = []
    for _ in range(600):
        latent = random.normal()
        grade = int(latent > -0.5) + int(latent > 0.8)
        values = np.array([max(latent, 0), max(-latent, 0), 1.0], dtype=np.float32)
        rows.append((grade, np.array([5, 9, 77]), values))
    model = quality.fit(rows, {0: 1.0, 1: 1.0, 2: 1.0})
    assert (np.diff(model.thresholds) > 0).all()
    score = np.array([model.weights[f] @ v for _, f, v in rows], dtype=float)
    found = model.tails(score)
    assert (np.diff(found, axis=1) <= 0).all()
    assert np.mean((found > 0.5).sum(axis=1) == [g for g, _, _ in rows]) > 0.95


def test_held_out_ratings(spark):
    docs = spark.read.parquet(f"{MEDIUM.replace('0.01', '0.1')}/documents.parquet")
    labels = spark.read.parquet(f"{MEDIUM.replace('0.01', '0.1')}/labels.parquet")
    seen, held = (labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(4)) != 0), labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0))
    rated = quality.graded(held).withColumnRenamed("doc_id", "_doc")
    found = quality.graded_documents(docs, seen).join(rated, F.col("doc_id") == F.col("_doc"))
    kept = {r["grade"]: r["kept"] for r in found.groupBy("grade").agg(F.avg(F.col("keep").cast("int")).alias("kept")).collect()}
    assert kept[2] > 0.98 and kept[1] < 0.12 and kept[0] < 0.12
    mean = {r["grade"]: r["e"] for r in found.groupBy("grade").agg(F.avg("expected_grade").alias("e")).collect()}
    assert mean[0] < mean[1] < mean[2]


def test_odd_documents(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (8, 1, 0), (13, 0, 1), (3, 1, 0), (None, 0, 0), (99, 1, 0)], RATINGS)
    found = quality.graded_documents(docs, labels)
    rows = found.collect()
    assert len(rows) == docs.count()
    assert set(docs.columns) - {"keep"} < set(found.columns)
    assert all(0 <= r["p_good"] <= r["p_fair"] <= 1 and r["keep"] == (r["p_good"] >= 0.5) for r in rows)
    assert len({r["p_good"] for r in rows if not (r["text"] or "").split()}) == 1
    selected = quality.select_quality(docs, labels)
    assert selected.columns == docs.columns and selected.count() == sum(r["keep"] for r in rows)


def test_without_ratings_everything_stays(spark):
    docs, none = documents(spark), spark.createDataFrame([], RATINGS)
    assert quality.select_quality(docs, none).count() == docs.count()
    assert quality.graded_documents(docs, none).where("keep AND p_good IS NULL").count() == docs.count()
    assert quality.graded_documents(empty(spark), none).count() == 0


def test_a_repeated_id_is_one_row_of_the_fit(spark, monkeypatch):
    rows = [(i, f"good words here number {i}" if i % 2 else f"bad stuff there item {i}") for i in range(40)]
    rows += [(1, f"copy {i % 7} of the first one") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], RATINGS)
    seen = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda rows, weight_of: seen.append((len(rows), weight_of)) or fit(rows, weight_of))
    first, second = quality.train(docs, labels), quality.train(docs.repartition(3), labels)
    assert seen == [(40, {1: 1.0, 2: 1.0})] * 2 and np.array_equal(first.weights, second.weights)
