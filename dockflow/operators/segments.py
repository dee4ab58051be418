"""Rider segments by K-Means and by rule.

Ride features take few distinct values, so equal rides are counted first and clustered as weighted
points: the same centres and costs as on single rides, at a fraction of the rows.
"""

from dataclasses import dataclass

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow import constants as K
from dockflow.functions.numeric import percent, weighted_avg
from dockflow.operators.explore import histogram

SAME_COST = 1e-9  # by which costs of equal clusters differ at most, from the order of sums


@dataclass(frozen=True)
class SegmentSpec:
    features: tuple[str, ...]
    k: int
    starts: int = 10
    seed: int = 42


RIDER_SPEC = SegmentSpec(
    (
        "duration_minutes",
        "is_weekend",
        "peak_hour_flag",
        "is_commuter_hour",
        "is_leisure_hour",
        "is_night",
    ),
    k=4,
)
MART_SPEC = SegmentSpec(("duration_minutes", "start_hour", "is_weekend", "peak_hour_flag"), k=3)


def rider_features(explored: DataFrame) -> DataFrame:
    """Behaviour flags per ride."""
    hour = F.col("start_hour")
    return explored.select(
        "rental_id",
        "duration_minutes",
        "start_hour",
        "is_weekend",
        "peak_hour_flag",
        "day_of_week",
        hour.isin(*K.COMMUTER_HOURS).cast("bigint").alias("is_commuter_hour"),
        hour.isin(*K.LEISURE_HOURS).cast("bigint").alias("is_leisure_hour"),
        hour.isin(*K.NIGHT_HOURS).cast("bigint").alias("is_night"),
    )


def weighted_points(rides: DataFrame, spec: SegmentSpec, extra: tuple[str, ...] = ()) -> DataFrame:
    """Distinct feature rows with the number of rides behind each."""
    numbers = [F.col(c).cast("double").alias(c) for c in spec.features]
    kept = [c for c in extra if c not in spec.features]
    counted = rides.select(*numbers, *kept).dropna(subset=list(spec.features))
    return counted.groupBy(*spec.features, *kept).agg(F.count(F.lit(1)).alias("n_rides"))


def moments(points: DataFrame, spec: SegmentSpec) -> list[tuple[float, float]]:
    """Mean and population deviation of every feature over rides; a constant feature has deviation 1.

    Deviations are taken from the mean in a second pass, so large means cost no digits.
    """
    n = F.col("n_rides").cast("double")
    means = points.agg(*[F.sum(F.col(c) * n) / F.sum(n) for c in spec.features]).first()
    if means[0] is None:
        return [(0.0, 1.0)] * len(spec.features)
    away = [F.col(c) - F.lit(mean) for c, mean in zip(spec.features, means)]
    variances = points.agg(*[F.sum(d * d * n) / F.sum(n) for d in away]).first()
    return [(mean, variance**0.5 or 1.0) for mean, variance in zip(means, variances)]


def standardized(points: DataFrame, spec: SegmentSpec) -> DataFrame:
    """Feature vector with mean 0 and population deviation 1 over rides, as ``scaled``."""
    columns = {
        f"z_{c}": (F.col(c) - F.lit(mean)) / F.lit(deviation)
        for c, (mean, deviation) in zip(spec.features, moments(points, spec))
    }
    assembler = VectorAssembler(inputCols=list(columns), outputCol="scaled")
    return assembler.transform(points.withColumns(columns)).drop(*columns)


def assign_to(points: DataFrame, spec: SegmentSpec, centres: list[tuple[float, ...]]) -> DataFrame:
    """Weighted points with the nearest of the given centres (in feature units), as ``cluster``.

    Features are standardized as for a fit; of equally near centres the first counts.
    """
    scales = [deviation for _, deviation in moments(points, spec)]
    near = [
        F.struct(
            sum(((F.col(c) - F.lit(float(at))) / F.lit(scale)) ** 2 for c, at, scale in zip(spec.features, centre, scales)).alias("distance"),
            F.lit(i).alias("cluster"),
        )
        for i, centre in enumerate(centres)
    ]
    return points.withColumn("cluster", F.least(*near)["cluster"])


def _kmeans(k: int, seed: int) -> KMeans:
    return KMeans(
        k=k, seed=seed, featuresCol="scaled", predictionCol="cluster", weightCol="n_rides"
    )


def fit_best(scaled: DataFrame, spec: SegmentSpec):
    """The lowest cost out of several starts."""
    fits = [_kmeans(spec.k, spec.seed + i).fit(scaled) for i in range(spec.starts)]
    return min(fits, key=lambda model: model.summary.trainingCost)


def fit_each(scaled: DataFrame, spec: SegmentSpec, ks: list[int]) -> list:
    """The model of lowest cost out of several starts for every number of clusters.

    All starts are followed to their end in one job (``operators.starts``), then Spark fits the best of each. Of starts that
    end alike the first counts, so clusters may be numbered otherwise than by ``fit_best``.
    """
    from dockflow.operators.starts import costs

    seeds = [spec.seed + i for i in range(spec.starts)]
    found = costs(scaled, _kmeans(spec.k, spec.seed), [(k, seed) for k in ks for seed in seeds])
    least = [min(found[k, seed] for seed in seeds) for k in ks]
    best = [next(seed for seed in seeds if found[k, seed] <= low * (1 + SAME_COST)) for k, low in zip(ks, least)]
    return [_kmeans(k, seed).fit(scaled) for k, seed in zip(ks, best)]


def scan_k(points: DataFrame, spec: SegmentSpec, ks=range(2, 8)) -> DataFrame:
    """Cost and silhouette per number of clusters, the best silhouette marked.

    The silhouette is that of all pairs of points (``operators.silhouette``), whose distances are taken once for all ``ks``;
    ``squared_silhouette`` is the evaluator's of Spark, which takes squared distances to the clusters' means.
    """
    from dockflow.operators.silhouette import mean_silhouettes

    scaled = standardized(points, spec).persist()
    models = fit_each(scaled, spec, [*ks])
    columns = [f"cluster_{k}" for k in ks]
    assigned = scaled
    for column, model in zip(columns, models):
        assigned = model.setPredictionCol(column).transform(assigned)
    squared = [
        ClusteringEvaluator(featuresCol="scaled", predictionCol=column, weightCol="n_rides").evaluate(assigned) for column in columns
    ]
    silhouettes = mean_silhouettes(assigned.drop("scaled"), spec, columns)
    rows = [
        (k, float(model.summary.trainingCost), float(pairs), float(means))
        for k, model, pairs, means in zip(ks, models, silhouettes, squared)
    ]
    scaled.unpersist()
    best = max(rows, key=lambda row: row[2])[0]
    return points.sparkSession.createDataFrame(
        [(*row, row[0] == best) for row in rows],
        "k int, inertia double, silhouette double, squared_silhouette double, is_best boolean",
    )


def assign(points: DataFrame, spec: SegmentSpec) -> DataFrame:
    """Weighted points with their cluster."""
    scaled = standardized(points, spec).persist()
    model = fit_best(scaled, spec)
    scaled.unpersist()
    return model.transform(scaled).drop("scaled")


def _mean(column: str, digits: int) -> Column:
    return F.round(weighted_avg(F.col(column), F.col("n_rides")), digits).alias(column)


def label_4(profile: DataFrame) -> Column:
    commuter, weekend, midday, evening = K.SEGMENTS_4
    return (
        F.when((F.col("is_commuter_hour") > 0.5) & (F.col("is_weekend") < 0.25), commuter)
        .when(F.col("is_weekend") > 0.4, weekend)
        .when(F.col("is_leisure_hour") > 0.5, midday)
        .otherwise(evening)
    )


def label_3(profile: DataFrame) -> Column:
    commuter, leisure, casual = K.SEGMENTS_3
    return (
        F.when(F.col("peak_hour_flag") > 0.35, commuter)
        .when(F.col("is_weekend") > 0.4, leisure)
        .otherwise(casual)
    )


def profile(assigned: DataFrame, spec: SegmentSpec) -> DataFrame:
    """Rides, share and rounded feature means per cluster, with the segment label."""
    four = spec.features == RIDER_SPEC.features
    total = assigned.agg(F.sum("n_rides")).scalar()
    grouped = assigned.groupBy("cluster").agg(
        F.sum("n_rides").alias("ride_count"), *[_mean(c, 3 if four else 2) for c in spec.features]
    )
    share = F.round(percent(F.col("ride_count"), total), 1)
    label = label_4(grouped) if four else label_3(grouped)
    return grouped.withColumns({"pct_of_total": share, "label": label}).orderBy("cluster")


def label_points(assigned: DataFrame, profiled: DataFrame) -> DataFrame:
    """Points with the label of their cluster, for reports by segment."""
    return assigned.join(profiled.select("cluster", "label"), "cluster")


def hourly_by_segment(labelled: DataFrame) -> DataFrame:
    """Share of each start hour within its segment, in percent; needs ``start_hour`` on the points."""
    counted = labelled.groupBy("label", "start_hour").agg(F.sum("n_rides").alias("rides"))
    totals = counted.groupBy(F.col("label").alias("total_of")).agg(F.sum("rides").alias("total"))
    return counted.join(totals, F.col("label") == F.col("total_of")).select(
        "label", "start_hour", "rides", percent(F.col("rides"), F.col("total")).alias("pct")
    )


def weekend_share_by_segment(labelled: DataFrame) -> DataFrame:
    share = weighted_avg(F.col("is_weekend"), F.col("n_rides")) * 100.0
    return labelled.groupBy("label").agg(share.alias("weekend_pct")).orderBy("weekend_pct")


def durations_by_segment(
    labelled: DataFrame, labels: list[str], clip_at: float | None = 60.0, bins: int = 30
) -> DataFrame:
    """Histogram of ride minutes per segment; rides longer than ``clip_at`` count at it."""
    minutes = F.col("duration_minutes")
    clipped = minutes if clip_at is None else F.least(minutes, F.lit(clip_at))
    points = labelled.select("label", clipped.alias("minutes"), "n_rides")
    return histogram(points, "label", "minutes", dict.fromkeys(labels, bins), weight="n_rides")


def commuter_share(labelled: DataFrame) -> DataFrame:
    """Percent of rides in segments whose label speaks of commuters, as the key finding ``pct_commuter``."""
    commuters = F.sum(F.when(F.col("label").contains("Commuter"), F.col("n_rides")).otherwise(0))
    share = percent(commuters, F.sum("n_rides"))
    return labelled.agg(share.alias("value")).select(F.lit("pct_commuter").alias("metric"), "value")


def rule_segments(rides: DataFrame) -> DataFrame:
    """Segment shares by rule: weekday peak rides commute, weekend rides are leisure, others casual."""
    commuter, leisure, casual = K.SEGMENTS_3
    segment = (
        F.when(F.col("is_weekend"), leisure)
        .when(F.col("peak_hour_flag") == 1, commuter)
        .otherwise(casual)
    )
    counted = rides.groupBy(segment.alias("segment")).agg(F.count(F.lit(1)).alias("rides"))
    total = counted.agg(F.sum("rides")).scalar()
    return counted.select("segment", "rides", percent(F.col("rides"), total).alias("pct"))
