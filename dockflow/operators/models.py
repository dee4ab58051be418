"""Demand models of Spark ML: ridge baseline, random forest, gradient boosting; trees are grown by ``operators.binned``."""

import json
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow import constants as K
from dockflow.operators import boosting
from dockflow.operators.binned import BinnedForestRegressor, BinnedGBTRegressor
from dockflow.session import let_go
from dockflow.sources import sinks

LINEAR, FOREST, BOOSTED = "Linear Regression", "Random Forest", "Gradient Boosting"
SECOND_ORDER = "Second-Order Boosting"
ROWS_PER_TASK = 100_000
SPLIT_KEYS = ["hire_date", "start_station_id", "hour"]


@dataclass(frozen=True)
class TrainSettings:
    """Model sizes; the defaults are those of the full training run."""

    ridge_alpha: float = 1.0
    forest_trees: int = 200
    forest_depth: int = 12
    forest_min_leaf: int = 3
    boost_rounds: int = 300
    boost_depth: int = 8
    boost_step: float = 0.05
    boost_rows: float = 0.8
    boost_columns: str = "0.8"
    boost_min_leaf: int = 5
    seed: int = 42


def split(features: DataFrame, train_tenths: int = 8) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by the md5 of their key: the same rows on every run, retry and engine.

    The first two of its digits are a number below 256, of which ``train_tenths`` tenths train.
    """
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in SPLIT_KEYS]))
    trains = F.substring(digest, 1, 2) < f"{round(256 * train_tenths / 10):02x}"
    return features.filter(trains), features.filter(~trains)


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=K.FEATURE_COLUMNS, outputCol="features")


def ridge_pipeline(train: DataFrame, settings: TrainSettings) -> Pipeline:
    """Ridge with the penalty on the sum of squares, expressed in Spark's scaled objective."""
    label = F.col(K.LABEL_COLUMN)
    n, spread = train.agg(F.count(label), F.stddev_pop(label)).first()
    penalty = settings.ridge_alpha * (spread or 0.0) / max(n, 1)
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    model = LinearRegression(
        featuresCol="scaled",
        labelCol=K.LABEL_COLUMN,
        elasticNetParam=0.0,
        standardization=False,
        solver="normal",
        regParam=penalty,
    )
    return Pipeline(stages=[_assembler(), scaler, model])


def forest_pipeline(settings: TrainSettings) -> Pipeline:
    model = BinnedForestRegressor(
        labelCol=K.LABEL_COLUMN,
        numTrees=settings.forest_trees,
        maxDepth=settings.forest_depth,
        minInstancesPerNode=settings.forest_min_leaf,
        featureSubsetStrategy="all",
        seed=settings.seed,
    )
    return Pipeline(stages=[_assembler(), model])


def boosted_pipeline(settings: TrainSettings) -> Pipeline:
    model = BinnedGBTRegressor(
        labelCol=K.LABEL_COLUMN,
        maxIter=settings.boost_rounds,
        maxDepth=settings.boost_depth,
        stepSize=settings.boost_step,
        subsamplingRate=settings.boost_rows,
        featureSubsetStrategy=settings.boost_columns,
        minInstancesPerNode=settings.boost_min_leaf,
        seed=settings.seed,
    )
    return Pipeline(stages=[_assembler(), model])


def fit_all(train: DataFrame, settings: TrainSettings) -> dict[str, PipelineModel]:
    """All models, fitted at the same time: each alone leaves most cores idle."""
    pipelines = {
        LINEAR: ridge_pipeline(train, settings),
        FOREST: forest_pipeline(settings),
        BOOSTED: boosted_pipeline(settings),
    }
    fit = inheritable_thread_target(train.sparkSession)(lambda pipeline: pipeline.fit(train))
    with ThreadPoolExecutor(len(pipelines)) as pool:
        return dict(zip(pipelines, pool.map(fit, pipelines.values()), strict=True))


def _scored(model: PipelineModel, test: DataFrame) -> DataFrame:
    return model.transform(test).select(F.col(K.LABEL_COLUMN).cast("double").alias("y"), "prediction")


def scores(predicted: DataFrame, name: str) -> DataFrame:
    """One row for predictions (y, prediction)."""
    error = F.col("y") - F.col("prediction")
    return predicted.agg(
        F.lit(name).alias("model"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.avg(error * error), F.var_pop("y"))).alias("r2"),
        F.count(F.lit(1)).alias("test_rows"),
    )


def evaluate(models: dict[str, PipelineModel], test: DataFrame) -> DataFrame:
    """RMSE, MAE and R² per model on the held-out rows."""
    return reduce(DataFrame.union, [scores(_scored(model, test), name) for name, model in models.items()])


def baseline_scores(features: DataFrame) -> DataFrame:
    """The trailing mean itself as a forecast, scored like a model on the held-out rows."""
    _, test = split(features)
    plain = test.select(F.col(K.LABEL_COLUMN).cast("double").alias("y"), F.col("rolling_7d_avg").alias("prediction"))
    return scores(plain, "Trailing mean")


def comparison(scores: DataFrame) -> DataFrame:
    """The model table, best first, with the winner by RMSE marked."""
    best = scores.agg(F.min("rmse")).scalar()
    return scores.withColumn("is_best", F.col("rmse") == best).orderBy("rmse", "model")


def train(features: DataFrame, settings: TrainSettings | None = None):
    """Fit and score all models; returns (models, comparison, name of the best)."""
    settings = settings or TrainSettings()
    train_rows, test_rows = split(features)
    # Every fit reads the training rows many times, in as few tasks as their number needs.
    tasks = max(1, -(-train_rows.count() // ROWS_PER_TASK))
    train_rows = train_rows.coalesce(tasks).persist()
    try:
        models = fit_all(train_rows, settings)
    finally:
        train_rows.unpersist()
    # Three rows: plain values from here on, nothing is scored twice. One model is sent out at a time.
    test_rows, found = test_rows.persist(), []
    try:
        for name, model in models.items():
            let_go(features.sparkSession)
            scored = evaluate({name: model}, test_rows)
            found += scored.collect()
    finally:
        test_rows.unpersist()
    table = features.sparkSession.createDataFrame(found, scored.schema)
    ranked = comparison(table)
    return models, ranked, ranked.first()["model"]


def second_order(features: DataFrame, settings: boosting.BoostSettings | None = None) -> tuple[boosting.BoostedModel, DataFrame]:
    """The boosted model of second order fitted on the training rows, and its scores on the held-out ones."""
    train_rows, test_rows = split(features)
    tasks = max(1, -(-train_rows.count() // ROWS_PER_TASK))
    model = boosting.fit(train_rows.coalesce(tasks), K.FEATURE_COLUMNS, K.LABEL_COLUMN, settings)
    predicted = model.transform(test_rows.select(*K.FEATURE_COLUMNS, K.LABEL_COLUMN))
    return model, scores(predicted.select(F.col(K.LABEL_COLUMN).cast("double").alias("y"), "prediction"), SECOND_ORDER)


def save_model(model: PipelineModel, path: str) -> str:
    """Save a fitted pipeline. Trees that lie in files are copied from there: as objects they can exceed the driver's memory."""
    *first, last = model.stages
    stored = getattr(last, "stored", None)
    if stored is None:
        model.write().overwrite().save(path)
        return path
    spark = SparkSession.active()
    sinks.remove(spark, path)
    uids = [stage.uid for stage in model.stages]
    folders = [f"{path}/stages/{i:0{len(str(len(uids)))}d}_{uid}" for i, uid in enumerate(uids)]
    for stage, folder in zip(first, folders):
        stage.write().save(folder)
    sinks.copy(spark, stored, folders[-1])
    about = {"class": "org.apache.spark.ml.PipelineModel", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
    text = json.dumps({**about, "uid": model.uid, "paramMap": {"stageUids": uids}, "defaultParamMap": {}})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_importance(models: dict[str, PipelineModel], spark) -> DataFrame:
    """Importance of every feature in the tree models, highest first."""
    rows = [
        (name, column, float(weight))
        for name, model in models.items()
        if hasattr(model.stages[-1], "featureImportances")
        for column, weight in zip(K.FEATURE_COLUMNS, model.stages[-1].featureImportances.toArray())
    ]
    table = spark.createDataFrame(rows, "model string, feature string, importance double")
    return table.orderBy("model", F.desc("importance"))
