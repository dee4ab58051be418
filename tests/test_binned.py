import uuid

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from dockflow import constants as K
from dockflow.operators import binned, models
from dockflow.sources import sinks

BOOST = dict(
    labelCol=K.LABEL_COLUMN, maxIter=8, maxDepth=5, stepSize=0.1, subsamplingRate=0.8, featureSubsetStrategy="0.8", minInstancesPerNode=5, seed=42
)
FOREST = dict(labelCol=K.LABEL_COLUMN, numTrees=7, maxDepth=8, minInstancesPerNode=3, featureSubsetStrategy="all", seed=42)


def demand(spark, n, seed=1):
    """Demand of stations and hours; one feature is constant, one has many values, zeros are frequent."""
    rng = np.random.default_rng(seed)
    hour, day, station = rng.integers(0, 24, n), rng.integers(1, 8, n), rng.integers(0, 90, n)
    mean = np.round(rng.gamma(2, 1, n) * (rng.random(n) < 0.7), 3)
    rides = 1 + rng.poisson(mean + (hour == 8) * 2 + station % 5 / 3)
    columns = dict(zip(K.FEATURE_COLUMNS, [hour, day, (day > 5).astype(int), np.zeros(n, int), np.full(n, 2), station, mean], strict=True))
    kinds = ", ".join(f"{c} {'double' if c == 'rolling_7d_avg' else 'bigint'}" for c in [*columns, K.LABEL_COLUMN])
    return spark.createDataFrame([tuple(v.item() for v in r) for r in zip(*columns.values(), rides, strict=True)], kinds)


@pytest.fixture(scope="module")
def rows(spark):
    """More rows than decide the bins, in one partition."""
    frame = demand(spark, 12_000).coalesce(1).persist()
    yield frame
    frame.unpersist()


def nodes(spark, model):
    path = sinks.fresh_path(spark, "nodes")
    model.save(path)
    return sorted(map(str, spark.read.parquet(f"{path}/data").collect()))


def jobs(spark, run):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_boosted_trees_are_those_of_spark(spark, rows):
    points = models._assembler().transform(rows)
    ours, theirs = (kind(**BOOST).fit(points) for kind in (binned.BinnedGBTRegressor, GBTRegressor))
    assert nodes(spark, ours) == nodes(spark, theirs)
    assert ours.treeWeights == theirs.treeWeights and ours.featureImportances == theirs.featureImportances


def test_forest_is_that_of_spark(spark, rows):
    points = models._assembler().transform(rows)
    ours, theirs = (kind(**FOREST).fit(points) for kind in (binned.BinnedForestRegressor, RandomForestRegressor))
    assert nodes(spark, ours) == nodes(spark, theirs)
    assert ours.featureImportances == theirs.featureImportances


def test_rounds_take_no_jobs(spark, rows):
    few, many = (models.boosted_pipeline(models.TrainSettings(boost_rounds=n, boost_depth=6)) for n in (2, 20))
    assert jobs(spark, lambda: few.fit(rows)) == jobs(spark, lambda: many.fit(rows))


def test_counted_rows_give_the_trees_of_single_ones(spark):
    """Without sampling nothing is drawn; a larger frame differs from Spark's by the order of sums only."""
    points = models._assembler().transform(demand(spark, 3000).repartition(3))
    plain = BOOST | dict(subsamplingRate=1.0, featureSubsetStrategy="all", maxIter=4)
    ours, theirs = (kind(**plain).fit(points).transform(points) for kind in (binned.BinnedGBTRegressor, GBTRegressor))
    x, y = (np.array([r[0] for r in p.orderBy(*K.FEATURE_COLUMNS, K.LABEL_COLUMN).select("prediction").collect()]) for p in (ours, theirs))
    assert np.allclose(x, y, atol=1e-9)


def test_samples_of_counted_rows_are_as_good(spark):
    train, test = (models._assembler().transform(demand(spark, n, seed).repartition(3)) for n, seed in ((6000, 2), (3000, 3)))

    def rmse(model):
        return models.scores(models._scored(model, test), "").first()["rmse"]

    for kinds, settings in (((binned.BinnedGBTRegressor, GBTRegressor), BOOST), ((binned.BinnedForestRegressor, RandomForestRegressor), FOREST)):
        ours, theirs = (rmse(kind(**settings).fit(train)) for kind in kinds)
        assert ours == pytest.approx(theirs, rel=0.03)


def test_a_weight_is_the_number_of_draws(spark):
    """Poisson draws of a partition in Spark's order: rows, and trees of a row."""
    drawn = binned.bootstraps_of(spark, 3000, 5, 1.0, 42)
    assert drawn.shape == (5, 3000) and drawn.mean() == pytest.approx(1.0, abs=0.05)
    assert drawn.var() == pytest.approx(1.0, abs=0.05)


@pytest.mark.parametrize("label", [3, None])
def test_rows_that_are_all_alike_or_none(spark, label):
    points = models._assembler().transform(demand(spark, 20).withColumns({c: F.lit(1) for c in [*K.FEATURE_COLUMNS, K.LABEL_COLUMN]}).coalesce(1))
    if label is None:
        with pytest.raises(ValueError, match="no rows"):
            binned.BinnedGBTRegressor(**BOOST).fit(points.limit(0))
        return
    for kind, settings in ((binned.BinnedGBTRegressor, BOOST), (binned.BinnedForestRegressor, FOREST)):
        assert {r.prediction for r in kind(**settings).fit(points).transform(points).collect()} == {1.0}


def test_a_forest_is_saved_from_its_files(spark, rows):
    fitted = models.forest_pipeline(models.TrainSettings(forest_trees=4, forest_depth=5)).fit(rows)
    path = models.save_model(fitted, models.save_model(fitted, sinks.fresh_path(spark, "model")))  # replaces itself
    again = models.load_model(path)
    assert [s.uid for s in again.stages] == [s.uid for s in fitted.stages]
    assert again.stages[-1].toDebugString == fitted.stages[-1].toDebugString
    assert again.transform(rows).select("prediction").collect() == fitted.transform(rows).select("prediction").collect()
