"""Declared column tests of the models; a test fails when it finds rows.

All NULL, range and value tests of a model share one pass, and every uniqueness test reads its key
column only.
"""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow import constants as K
from dockflow.operators import uniqueness
from dockflow.operators.quality import orphan_keys, union_all

ZONES = [box[0] for box in K.ZONE_BOXES] + [K.ZONE_ELSE]


@dataclass(frozen=True)
class ColumnTest:
    column: str
    kind: str
    args: tuple = field(default=())
    severity: str = "error"


def _not_null(*columns: str) -> list[ColumnTest]:
    return [ColumnTest(c, "not_null") for c in columns]


def _unique(*columns: str) -> list[ColumnTest]:
    return [ColumnTest(c, "unique") for c in columns]


STAGING_TESTS = {
    "cycle_hire": [
        *_not_null("rental_id", "duration", "start_date", "start_station_id"),
        *_unique("rental_id"),
        ColumnTest("end_station_id", "not_null", severity="warn"),
    ],
    "cycle_stations": [
        *_not_null("id", "docks_count", "latitude", "longitude"),
        *_unique("id"),
    ],
    "stg_cycle_hire": [
        *_not_null("rental_id", "duration_seconds", "start_station_id", "start_datetime", "hire_date", "is_weekend"),
        *_unique("rental_id"),
        ColumnTest("duration_seconds", "accepted_range", (60, 86400)),
        ColumnTest("end_station_id", "not_null", severity="warn"),
    ],
    "stg_cycle_stations": [
        *_not_null("station_id", "nb_docks", "zone", "capacity_tier"),
        *_unique("station_id"),
        ColumnTest("nb_docks", "accepted_range", (1, 100)),
        ColumnTest("latitude", "accepted_range", K.STATION_LAT),
        ColumnTest("longitude", "accepted_range", K.STATION_LON),
        ColumnTest("zone", "accepted_values", tuple(ZONES)),
        ColumnTest("capacity_tier", "accepted_values", tuple(K.CAPACITY_TIERS)),
    ],
}

MART_TESTS = {
    "fact_rides": [
        *_not_null("ride_sk", "rental_id", "hire_date", "duration_minutes", "peak_hour_flag", "start_station_is_imbalanced", "start_station_id"),
        *_unique("ride_sk", "rental_id"),
        ColumnTest("duration_minutes", "accepted_range", (1, 1440)),
        ColumnTest("peak_hour_flag", "accepted_range", (0, 1)),
        ColumnTest("start_station_id", "relationships", ("dim_stations", "station_id"), "warn"),
        ColumnTest("duration_band", "accepted_values", tuple(K.DURATION_BANDS)),
    ],
    "dim_stations": [
        *_not_null("station_sk", "station_id", "zone", "rebalancing_priority", "nb_docks"),
        *_unique("station_sk", "station_id"),
        ColumnTest("rebalancing_priority", "accepted_values", tuple(K.PRIORITIES)),
        ColumnTest("nb_docks", "accepted_range", (1, 100)),
    ],
    "dim_date": [
        *_not_null("date_id", "full_date", "is_weekend"),
        *_unique("date_id", "full_date"),
        ColumnTest("season", "accepted_values", tuple(K.SEASONS)),
    ],
}


def _literal(value) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def _failing_rows(test: ColumnTest) -> str:
    """Aggregate for the tests that look at one row at a time. NULL passes all but ``not_null``."""
    if test.kind == "not_null":
        return f"count_if({test.column} IS NULL)"
    if test.kind == "accepted_range":
        low, high = test.args
        return f"count_if({test.column} NOT BETWEEN {low} AND {high})"
    return f"count_if({test.column} NOT IN ({', '.join(map(_literal, test.args))}))"


def _keys_repeated(table: DataFrame, column: str) -> DataFrame:
    key = uniqueness.surrogate_or_number(table, column, "rental_id") if column == "ride_sk" else column
    return uniqueness.repeated_keys(table, key).agg(F.count(F.lit(1)).alias("t0"))


def _rows_lost(table: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    lost = orphan_keys(table, column, parent, key)
    return lost.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("t0"))


def _as_rows(counts: DataFrame, model: str, tests: list[ColumnTest]) -> DataFrame:
    """One row per test from one row with the failures of test i in column ``t{i}``."""
    rows = ", ".join(
        f"'{model}', '{t.column}', '{t.kind}', '{t.severity}', t{i}" for i, t in enumerate(tests)
    )
    return counts.selectExpr(
        f"stack({len(tests)}, {rows}) AS (model, column_name, test, severity, failures)"
    )


def _model_rows(model: str, tests: list[ColumnTest], tables: dict[str, DataFrame]) -> list[DataFrame]:
    table = tables[model]
    by_row = [t for t in tests if t.kind in ("not_null", "accepted_range", "accepted_values")]
    counts = table.agg(*[F.expr(_failing_rows(t)).alias(f"t{i}") for i, t in enumerate(by_row)])
    out = [_as_rows(counts, model, by_row)]
    for test in tests:
        if test.kind == "unique":
            out.append(_as_rows(_keys_repeated(table, test.column), model, [test]))
        elif test.kind == "relationships":
            parent, key = test.args
            out.append(_as_rows(_rows_lost(table, test.column, tables[parent], key), model, [test]))
    return out


def run_schema_tests(tests: dict[str, list[ColumnTest]], tables: dict[str, DataFrame]) -> DataFrame:
    """One row per test: model, column_name, test, severity, failures, status."""
    parts = [row for model, listed in tests.items() for row in _model_rows(model, listed, tables)]
    broken = F.when(F.col("severity") == "warn", "WARN").otherwise("ERROR")
    status = F.when(F.col("failures") == 0, "PASS").otherwise(broken)
    return union_all(parts).withColumn("status", status)


def as_check_results(test_rows: DataFrame, checkpoint: str) -> DataFrame:
    """Schema test rows in the shape of check results, so one gate serves both."""
    return test_rows.select(
        F.lit(checkpoint).alias("checkpoint"),
        F.concat_ws(".", "model", "column_name").alias("check_id"),
        F.col("test").alias("check"),
        "status",
        F.col("failures").cast("double").alias("value"),
        F.lit(0.0).alias("threshold"),
        "severity",
    )


def rides_ending_before_start(fact: DataFrame) -> DataFrame:
    """Rides whose end is not after their start, or whose duration is not positive."""
    wrong = (F.col("end_datetime") <= F.col("start_datetime")) | (F.col("duration_seconds") <= 0)
    return fact.filter(wrong).select(
        "rental_id", "start_datetime", "end_datetime", "duration_seconds"
    )
