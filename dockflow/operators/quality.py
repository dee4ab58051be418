"""Data checks that cost one aggregation per table, and the gates that act on them.

Counters of a table share one pass. Uniqueness is counted on the key column alone, so wide rows are
never shuffled for it. Results are rows: checkpoint, check, status, value, threshold, severity.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow import constants as K
from dockflow.operators import uniqueness
from dockflow.sources import sinks

RESULT_COLUMNS = ["checkpoint", "check_id", "check", "status", "value", "threshold", "severity"]
ERROR, WARNING = "error", "warning"


class QualityError(RuntimeError):
    """Raised by a gate when a check has failed."""


@dataclass(frozen=True)
class Check:
    """``value`` is the SQL text of an aggregate; ``rule`` compares it with ``threshold``."""

    check_id: str
    name: str
    value: str = "value"
    reads: tuple[str, ...] = ()
    rule: str = "zero"
    threshold: float | None = None
    severity: str = ERROR

    def passes(self) -> str:
        return {
            "zero": f"{self.check_id} = 0",
            "at_least": f"{self.check_id} >= {self.threshold}",
            "below": f"{self.check_id} < {self.threshold}",
        }[self.rule]


def _as_results(values: DataFrame, checkpoint: str, checks: list[Check]) -> DataFrame:
    """Turn one row with a column per check id into one row per check.

    A warning lowers a failure to WARN, but a value that could not be computed always fails.
    """
    rows = []
    for c in checks:
        bad = "FAIL" if c.severity == ERROR else "WARN"
        limit = "NULL" if c.threshold is None else c.threshold
        rows.append(
            f"'{checkpoint}', '{c.check_id}', '{c.name}', "
            f"CASE WHEN {c.check_id} IS NULL THEN 'FAIL' WHEN {c.passes()} THEN 'PASS' ELSE '{bad}' END, "
            f"CAST({c.check_id} AS DOUBLE), CAST({limit} AS DOUBLE), '{c.severity}'"
        )
    names = ", ".join(f"`{c}`" for c in RESULT_COLUMNS)
    return values.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS ({names})")


def run_checks(table: DataFrame, checkpoint: str, checks: list[Check]) -> DataFrame:
    """All checks of a table in one pass. A check on a column that is not there has no value."""
    present = set(table.columns)
    values = [
        F.expr(c.value if set(c.reads) <= present else "max(CAST(NULL AS BIGINT))").alias(c.check_id)
        for c in checks
    ]
    return _as_results(table.agg(*values), checkpoint, checks)


def run_check_on(values: DataFrame, checkpoint: str, check: Check) -> DataFrame:
    """A check whose value comes from its own one-row frame with the column ``value``."""
    return _as_results(values.select(F.col("value").alias(check.check_id)), checkpoint, [check])


def repeats(table: DataFrame, key: str, null_is_value: bool = False) -> DataFrame:
    """Rows minus distinct keys. NULL is not a key unless ``null_is_value``."""
    if not null_is_value:
        return uniqueness.surplus_rows(table, key)
    counted = table.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg((F.coalesce(F.sum("n"), F.lit(0)) - F.count(F.lit(1))).alias("value"))


def orphan_keys(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows of the child per key that the parent lacks; NULL keys are not orphans."""
    counted = child.groupBy(F.col(child_key).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    known = parent.select(F.col(parent_key).alias("known"))
    return counted.filter(F.col("key").isNotNull()).join(
        known, F.col("key") == F.col("known"), "left_anti"
    )


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, parts)


def _null(column: str) -> str:
    return f"count_if({column} IS NULL)"


def _outside(column: str, low, high) -> str:
    return f"count_if({column} < {low} OR {column} > {high})"


ROWS = "count(1)"


def post_ingest(rides: DataFrame, stations: DataFrame, min_rows: int = 1_000_000) -> DataFrame:
    """The 16 checks of the raw tables."""
    point = "post_ingest"
    ride_checks = [
        Check("Q01", "rental_id not null", _null("rental_id"), ("rental_id",)),
        Check("Q03", "start_date not null", _null("start_date"), ("start_date",)),
        Check("Q04", "start_date from 2010 on", "count_if(start_date < TIMESTAMP '2010-01-01')", ("start_date",)),
        Check("Q05", "duration not null", _null("duration"), ("duration",)),
        Check("Q06", "duration within 60 to 86400 seconds",
              _outside("duration", K.MIN_RIDE_SECONDS, K.MAX_RIDE_SECONDS), ("duration",),
              severity=WARNING),
        Check("Q07", "start_station_id not null", _null("start_station_id"), ("start_station_id",)),
        Check("Q08", "end_station_id not null", _null("end_station_id"), ("end_station_id",),
              severity=WARNING),
        Check("Q09", "end_date after start_date", "count_if(end_date <= start_date)", ("start_date", "end_date"),
              severity=WARNING),
        Check("Q10", "enough rides", ROWS, (), "at_least", min_rows),
    ]
    station_checks = [
        Check("Q11", "station id not null", _null("id"), ("id",)),
        Check("Q13", "latitude in service area", _outside("latitude", *K.STATION_LAT), ("latitude",)),
        Check("Q14", "longitude in service area", _outside("longitude", *K.STATION_LON),
              ("longitude",)),
        Check("Q15", "docks positive", "count_if(docks_count <= 0)", ("docks_count",)),
        Check("Q16", "station name not null", _null("name"), ("name",)),
    ]
    return union_all(
        [
            run_checks(rides, point, ride_checks),
            run_check_on(
                repeats(rides, "rental_id"), point, Check("Q02", "rental_id unique")
            ),
            run_checks(stations, point, station_checks),
            run_check_on(repeats(stations, "id"), point, Check("Q12", "station id unique")),
        ]
    )


def post_transform(
    fact: DataFrame, dim_stations: DataFrame, dim_date: DataFrame, min_rows: int = 1_000_000
) -> DataFrame:
    """The 18 checks of the mart tables."""
    point = "post_transform"
    key_columns = ["start_station_name", "hire_date", "duration_minutes"]
    null_cells = " + ".join(_null(c) for c in key_columns)
    bands = ", ".join(f"'{band}'" for band in K.DURATION_BANDS)
    fact_checks = [
        Check("Q17", "rental_id not null", _null("rental_id"), ("rental_id",)),
        Check("Q19", "duration_minutes within 1 to 1440", _outside("duration_minutes", 1, 1440),
              ("duration_minutes",)),
        Check("Q20", "start_station_id not null", _null("start_station_id"), ("start_station_id",)),
        Check("Q21", "hire_date not null", _null("hire_date"), ("hire_date",)),
        Check("Q22", "start_hour within 0 to 23", _outside("start_hour", 0, 23), ("start_hour",)),
        Check("Q23", "duration_band known", f"count_if(duration_band NOT IN ({bands}))", ("duration_band",)),
        Check("Q24", "NULL rate of key columns", f"try_divide({null_cells}, count(1) * 3.0D)",
              tuple(key_columns), "below", 0.05, WARNING),
        Check("Q25", "end after start",
              "count_if(end_datetime <= start_datetime)",
              ("start_datetime", "end_datetime")),
        Check("Q26", "imbalance score within 0 to 1",
              _outside("start_station_imbalance_score", 0, 1), ("start_station_imbalance_score",)),
        Check("Q27", "enough rides", ROWS, (), "at_least", min_rows),
    ]
    station_checks = [
        Check("Q28", "station_id not null", _null("station_id"), ("station_id",)),
        Check("Q30", "latitude plausible", _outside("latitude", 51.0, 52.0), ("latitude",)),
        Check("Q31", "docks positive", "count_if(nb_docks <= 0)", ("nb_docks",)),
    ]
    date_checks = [Check("Q33", "enough days", ROWS, (), "at_least", 3650)]
    orphans = orphan_keys(fact, "start_station_id", dim_stations, "station_id").agg(
        F.count(F.lit(1)).alias("value")
    )
    unique = [
        ("Q18", "ride_sk unique", fact, uniqueness.surrogate_or_number(fact, "ride_sk", "rental_id")),
        ("Q29", "station_id unique", dim_stations, "station_id"),
        ("Q34", "date_id unique", dim_date, "date_id"),
    ]
    return union_all(
        [
            run_checks(fact, point, fact_checks),
            run_checks(dim_stations, point, station_checks),
            run_checks(dim_date, point, date_checks),
            run_check_on(
                orphans,
                point,
                Check("Q32", "start stations known", severity=WARNING),
            ),
            *[
                run_check_on(repeats(table, key), point, Check(check_id, name))
                for check_id, name, table, key in unique
            ],
        ]
    )


def one_row_per_station_day(daily: DataFrame) -> DataFrame:
    """The check that a known station has one row a day: two (as under two names) would multiply its rides in the fact."""
    known = daily.filter(F.col("station_id").isNotNull()).select(F.struct("hire_date", "station_id").alias("key"))
    return run_check_on(repeats(known, "key"), "station_days", Check("D01", "one row per station and day"))


def _breaks(condition: str) -> str:
    """Rows where the condition is not true; an unknown value breaks it."""
    return f"count_if(NOT coalesce({condition}, false))"


def delivered_files(
    rides: DataFrame, stations: DataFrame, min_rides: int = 1000, min_stations: int = 100
) -> DataFrame:
    """File-level checks before loading, with the stricter generation rules."""
    point = "files"
    known = lambda c: _breaks(f"{c} IS NOT NULL")
    ride_checks = [
        Check("F01", "rental_id not null", known("rental_id"), ("rental_id",)),
        Check("F02", "bike_id not null", known("bike_id"), ("bike_id",)),
        Check("F03", "start_date not null", known("start_date"), ("start_date",)),
        Check("F04", "start_station_id not null", known("start_station_id"), ("start_station_id",)),
        Check("F05", "duration positive", _breaks("duration > 0"), ("duration",)),
        Check("F13", "enough rides", ROWS, (), "at_least", min_rides),
        Check("G04", "duration within 60 to 86400 seconds",
              _breaks(f"duration BETWEEN {K.MIN_RIDE_SECONDS} AND {K.MAX_RIDE_SECONDS}"),
              ("duration",)),
        Check("G05", "end_station_id not null", known("end_station_id"), ("end_station_id",)),
        Check("G06", "end after start", _breaks("end_date > start_date"),
              ("start_date", "end_date")),
    ]
    station_checks = [
        Check("F06", "station id not null", known("id"), ("id",)),
        Check("F07", "station name not null", known("name"), ("name",)),
        Check("F08", "docks positive", _breaks("docks_count > 0"), ("docks_count",)),
        Check("F11", "latitude in service area", _breaks("latitude BETWEEN {} AND {}".format(*K.STATION_LAT)),
              ("latitude",)),
        Check("F12", "longitude in service area",
              _breaks("longitude BETWEEN {} AND {}".format(*K.STATION_LON)), ("longitude",)),
        Check("F14", "enough stations", ROWS, (), "at_least", min_stations),
    ]
    unique = [("F09", "rental_id unique", rides, "rental_id"), ("F10", "station id unique", stations, "id")]
    return union_all(
        [
            run_checks(rides, point, ride_checks),
            run_checks(stations, point, station_checks),
            *[
                run_check_on(
                    repeats(table, key, null_is_value=True),
                    point,
                    Check(check_id, name),
                )
                for check_id, name, table, key in unique
            ],
        ]
    )


def gate(results: DataFrame) -> None:
    """Stop when any check failed; warnings pass. Only the failed checks reach the driver."""
    failed = results.filter(F.col("status").isin("FAIL", "ERROR")).collect()
    if failed:
        names = ", ".join(f"{row['check_id']} {row['check']} ({row['value']})" for row in failed)
        raise QualityError(f"{len(failed)} checks failed: {names}")


def status_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("checkpoint", "status").agg(F.count(F.lit(1)).alias("checks"))


def overall(results: DataFrame) -> DataFrame:
    """The run header: time, overall status and counts."""
    failed = F.count_if(F.col("status").isin("FAIL", "ERROR"))
    return results.agg(
        F.current_timestamp().alias("run_timestamp"),
        F.when(failed == 0, "PASS").otherwise("FAIL").alias("overall_status"),
        F.count(F.lit(1)).alias("checks"),
        failed.alias("failed"),
    )


def save_results(results: DataFrame, path: str) -> str:
    return sinks.write_json(results, path)


def read_results(spark, path: str) -> DataFrame:
    schema = ", ".join(
        f"`{c}` {'double' if c in ('value', 'threshold') else 'string'}" for c in RESULT_COLUMNS
    )
    return spark.read.schema(schema).json(path)
