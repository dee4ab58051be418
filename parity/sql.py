"""ANSI SQL for every registered query, written ride by ride as the definitions state them.

Each text is self-contained: ``compose`` puts the common table expressions it mentions in front.
"""

import re

from dockflow import constants as K
from dockflow.operators.segments import MART_SPEC, RIDER_SPEC
from parity import registry as Q

D = f"hire_date BETWEEN DATE '{Q.DATE_FROM}' AND DATE '{Q.DATE_TO}'"

ZONE_CASE = (
    "CASE "
    + " ".join(
        f"WHEN {{lat}} BETWEEN {a} AND {b} AND {{lon}} BETWEEN {c} AND {d} THEN '{name}'"
        for name, a, b, c, d in K.ZONE_BOXES
    )
    + " ELSE 'Other' END"
)

CTES: dict[str, str] = {}

# --- raw tables -------------------------------------------------------------------------------
CTES["event_keys"] = """
SELECT event_id, event_type, value, date_trunc('second', ts) AS ts0, (user_id * 2) // 3 AS b,
       CAST(json_extract(props, '$.k') AS BIGINT) AS k, (SELECT count(*) FROM supplier) AS n
FROM events"""
CTES["ride_ids"] = """
SELECT event_id AS rental_id, CAST(floor(value * 30) AS BIGINT) AS duration, event_id % 997 AS bike_id,
       ts0 + to_seconds(CAST(floor(value * 30) AS BIGINT)) AS end_date,
       CASE WHEN k % 50 = 0 THEN NULL
            WHEN event_type = 'signup' THEN (b * b) % n
            WHEN k >= 95 THEN (b + k) % n
            ELSE ((b + k) * (b + k)) % n END AS end_station_id,
       ts0 AS start_date, (b * b) % n AS start_station_id
FROM event_keys"""
CTES["cycle_hire"] = """
SELECT r.rental_id, r.duration, r.bike_id, r.end_date, r.end_station_id, e.s_name AS end_station_name,
       r.start_date, r.start_station_id, s.s_name AS start_station_name
FROM ride_ids r LEFT JOIN supplier s ON r.start_station_id = s.s_suppkey
LEFT JOIN supplier e ON r.end_station_id = e.s_suppkey"""
CTES["cycle_stations"] = """
SELECT CAST(s_suppkey AS BIGINT) AS id, s_suppkey % 33 <> 0 AS installed, s_suppkey % 33 = 1 AS locked,
       CAST(DATE '2010-01-01' + CAST(s_suppkey * 13 % 1460 AS INTEGER) AS DATE) AS install_date,
       s_name AS name, lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS terminal_name,
       CASE WHEN s_suppkey % 97 = 96 THEN 52e0 ELSE (51450 + s_suppkey * 37 % 110) / 1e3 END AS latitude,
       (s_suppkey * 53 % 260 - 230) / 1e3 AS longitude,
       CAST(CASE WHEN s_suppkey % 89 = 80 THEN 0 ELSE 10 + s_suppkey * 7 % 31 END AS BIGINT) AS docks_count,
       s_suppkey % 20 = 0 AS temporary
FROM supplier"""

# --- warehouse --------------------------------------------------------------------------------
CTES["stg_rides"] = """
SELECT rental_id, bike_id, start_station_id, start_station_name, end_station_id, end_station_name,
       start_date AS start_datetime, end_date AS end_datetime, CAST(start_date AS DATE) AS hire_date,
       CAST(hour(start_date) AS BIGINT) AS start_hour,
       CAST(dayofweek(start_date) + 1 AS BIGINT) AS day_of_week,
       dayofweek(start_date) IN (0, 6) AS is_weekend, duration AS duration_seconds
FROM cycle_hire
WHERE rental_id IS NOT NULL AND duration BETWEEN 60 AND 86400 AND end_date > start_date"""
CTES["stg_stations"] = f"""
SELECT id AS station_id, name AS station_name, terminal_name, latitude, longitude,
       {ZONE_CASE.format(lat="latitude", lon="longitude")} AS zone, docks_count AS nb_docks,
       installed AS is_installed, locked AS is_locked, temporary AS is_temporary,
       CASE WHEN docks_count <= 15 THEN 'small' WHEN docks_count <= 24 THEN 'medium'
            ELSE 'large' END AS capacity_tier,
       install_date
FROM cycle_stations
WHERE id IS NOT NULL AND latitude BETWEEN 51.3 AND 51.7 AND longitude BETWEEN -0.6 AND 0.3
  AND docks_count > 0"""
CTES["rides_enriched"] = """
SELECT r.rental_id, r.bike_id, r.start_datetime, r.end_datetime, r.hire_date, r.start_hour,
       r.day_of_week, r.is_weekend, r.duration_seconds,
       round(r.duration_seconds / 60e0, 1) AS duration_minutes,
       CASE WHEN r.duration_seconds < 600 THEN 'short' WHEN r.duration_seconds < 1800 THEN 'medium'
            WHEN r.duration_seconds < 3600 THEN 'long' ELSE 'extended' END AS duration_band,
       CAST(CASE WHEN r.start_hour IN (7, 8, 17, 18) THEN 1 ELSE 0 END AS BIGINT) AS peak_hour_flag,
       CASE WHEN r.start_hour BETWEEN 7 AND 9 THEN 'am_peak'
            WHEN r.start_hour BETWEEN 17 AND 19 THEN 'pm_peak'
            WHEN r.start_hour BETWEEN 10 AND 16 THEN 'midday'
            WHEN r.start_hour BETWEEN 20 AND 23 THEN 'evening' ELSE 'night' END AS time_period,
       r.start_station_id, r.start_station_name, a.zone AS start_zone, a.nb_docks AS start_nb_docks,
       a.capacity_tier AS start_capacity_tier, a.latitude AS start_lat, a.longitude AS start_lon,
       r.end_station_id, r.end_station_name, b.zone AS end_zone, b.nb_docks AS end_nb_docks,
       b.capacity_tier AS end_capacity_tier, b.latitude AS end_lat, b.longitude AS end_lon,
       CASE WHEN r.start_station_id = r.end_station_id THEN TRUE ELSE FALSE END AS is_round_trip
FROM stg_rides r LEFT JOIN stg_stations a ON r.start_station_id = a.station_id
LEFT JOIN stg_stations b ON r.end_station_id = b.station_id"""
CTES["ride_ends"] = """
SELECT hire_date, start_station_id AS station_id, start_station_name AS station_name, start_zone AS zone,
       start_nb_docks AS nb_docks, start_lat AS latitude, start_lon AS longitude, TRUE AS leaves,
       peak_hour_flag AS peak, duration_minutes AS minutes FROM rides_enriched
UNION ALL
SELECT hire_date, end_station_id, NULL, NULL, NULL, NULL, NULL, FALSE, peak_hour_flag, NULL FROM rides_enriched
WHERE end_station_id IS NOT NULL"""
CTES["end_counts"] = """
SELECT hire_date, station_id, station_name, zone, nb_docks, latitude, longitude, leaves, count(*) AS moves,
       CAST(sum(peak) AS BIGINT) AS peak_moves, avg(minutes) AS avg_duration_mins FROM ride_ends GROUP BY ALL"""
CTES["day_moves"] = """
SELECT *, CAST(coalesce(sum(moves) FILTER (WHERE NOT leaves) OVER same, 0) AS BIGINT) AS came,
       CAST(coalesce(sum(peak_moves) FILTER (WHERE NOT leaves) OVER same, 0) AS BIGINT) AS peak_came
FROM end_counts WINDOW same AS (PARTITION BY hire_date, station_id)"""
CTES["daily_moves"] = """
SELECT hire_date, station_id, station_name, zone, nb_docks, latitude, longitude, moves AS total_departures,
       came AS total_arrivals, peak_moves AS peak_departures, peak_came AS peak_arrivals, avg_duration_mins,
       moves - came AS net_flow, (moves + came) / nullif(nb_docks * 2e0, 0) AS utilisation_rate,
       abs(moves - came) / CAST(greatest(moves + came, 1) AS DOUBLE) AS imbalance_score
FROM day_moves WHERE leaves"""
CTES["station_daily"] = """
SELECT *, imbalance_score > 0.2 AS is_imbalanced,
       CASE WHEN net_flow > 0 THEN 'draining' WHEN net_flow < 0 THEN 'filling' ELSE 'balanced' END
         AS imbalance_direction
FROM daily_moves"""
CTES["station_rolling"] = """
SELECT *, avg(total_departures) OVER (PARTITION BY station_id ORDER BY hire_date
         ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_7d_avg_departures
FROM station_daily"""
CTES["fact"] = """
SELECT md5(CAST(r.rental_id AS VARCHAR)) AS ride_sk, r.rental_id, r.bike_id, r.hire_date, r.start_datetime,
       r.end_datetime, r.start_hour, r.day_of_week, r.is_weekend, r.time_period, r.peak_hour_flag,
       r.duration_seconds, r.duration_minutes, r.duration_band, r.start_station_id, r.start_station_name,
       r.start_zone, r.start_nb_docks, r.start_capacity_tier, r.start_lat, r.start_lon, r.end_station_id,
       r.end_station_name, r.end_zone, r.end_nb_docks, r.end_capacity_tier, r.end_lat, r.end_lon,
       r.is_round_trip, coalesce(s.imbalance_score, 0) AS start_station_imbalance_score,
       coalesce(s.is_imbalanced, FALSE) AS start_station_is_imbalanced,
       coalesce(s.imbalance_direction, 'balanced') AS start_station_imbalance_direction,
       coalesce(s.net_flow, 0) AS start_station_net_flow,
       coalesce(s.utilisation_rate, 0) AS start_station_utilisation_rate,
       coalesce(s.rolling_7d_avg_departures, 0) AS start_station_rolling_7d_avg
FROM rides_enriched r LEFT JOIN station_rolling s
  ON r.hire_date = s.hire_date AND r.start_station_id = s.station_id"""
CTES["fact_rounded"] = """
SELECT * REPLACE (round(start_station_imbalance_score, 6) AS start_station_imbalance_score,
                  round(start_station_utilisation_rate, 6) AS start_station_utilisation_rate,
                  round(start_station_rolling_7d_avg, 6) AS start_station_rolling_7d_avg)
FROM fact"""
CTES["station_history"] = """
SELECT station_id, avg(imbalance_score) AS score, avg(utilisation_rate) AS utilisation,
       CAST(sum(total_departures) AS BIGINT) AS departures, CAST(sum(total_arrivals) AS BIGINT) AS arrivals,
       max(hire_date) AS last_activity_date
FROM station_daily GROUP BY 1"""
CTES["dim_stations"] = """
SELECT md5(CAST(s.station_id AS VARCHAR)) AS station_sk, s.station_id, s.station_name, s.terminal_name,
       s.latitude, s.longitude, s.zone, s.nb_docks, s.capacity_tier, s.is_installed, s.is_locked,
       s.is_temporary, s.install_date, coalesce(h.score, 0) AS avg_imbalance_score_7d,
       coalesce(h.utilisation, 0) AS avg_utilisation_rate_7d,
       coalesce(h.departures, 0) AS total_departures_all_time,
       coalesce(h.arrivals, 0) AS total_arrivals_all_time, h.last_activity_date,
       CASE WHEN coalesce(h.score, 0) >= 0.25 THEN 'CRITICAL' WHEN coalesce(h.score, 0) >= 0.18 THEN 'HIGH'
            WHEN coalesce(h.score, 0) >= 0.10 THEN 'MEDIUM' ELSE 'LOW' END AS rebalancing_priority
FROM stg_stations s LEFT JOIN station_history h ON s.station_id = h.station_id"""
_HOLIDAYS = ", ".join(f"(DATE '{d}', '{n}')" for d, n in K.MART_HOLIDAYS)
CTES["bank_holidays"] = f"SELECT * FROM (VALUES {_HOLIDAYS}) AS h(holiday_date, holiday_name)"
CTES["spine"] = f"""
SELECT CAST(unnest(generate_series(DATE '{K.SPINE_START}', DATE '{K.SPINE_END}' - 1, INTERVAL 1 DAY)) AS DATE) AS d"""
CTES["dim_date"] = """
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_id, d AS full_date, CAST(year(d) AS BIGINT) AS year,
       CAST(quarter(d) AS BIGINT) AS quarter, CAST(month(d) AS BIGINT) AS month,
       strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_abbr,
       CAST(strftime(d, '%U') AS BIGINT) AS week_number, CAST(dayofweek(d) + 1 AS BIGINT) AS day_of_week,
       strftime(d, '%A') AS day_name, strftime(d, '%a') AS day_abbr, dayofweek(d) IN (0, 6) AS is_weekend,
       holiday_date IS NOT NULL AS is_uk_bank_holiday, holiday_name AS bank_holiday_name,
       CASE WHEN month(d) IN (12, 1, 2) THEN 'winter' WHEN month(d) IN (3, 4, 5) THEN 'spring'
            WHEN month(d) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season
FROM spine LEFT JOIN bank_holidays ON d = holiday_date"""

# --- lists ------------------------------------------------------------------------------------


def _list(min_rides: int, band: float) -> str:
    return f"""
SELECT station, zone, lat, lon, nb_docks, imb_score, net_flow, imb_direction, total_rides,
       CASE WHEN net_flow > {band} THEN 'DELIVER BIKES' WHEN net_flow < -{band} THEN 'COLLECT BIKES'
            ELSE 'MONITOR' END AS action,
       CASE WHEN imb_score <= 0.10 THEN 'LOW' WHEN imb_score <= 0.18 THEN 'MEDIUM'
            WHEN imb_score <= 0.25 THEN 'HIGH' ELSE 'CRITICAL' END AS priority
FROM (SELECT start_station_name AS station, start_zone AS zone, start_lat AS lat, start_lon AS lon,
             start_nb_docks AS nb_docks, round(avg(start_station_imbalance_score), 3) AS imb_score,
             round(avg(start_station_net_flow), 1) AS net_flow,
             start_station_imbalance_direction AS imb_direction, count(*) AS total_rides
      FROM fact WHERE {D} GROUP BY ALL HAVING count(*) > {min_rides})"""


CTES["rebalancing"] = _list(Q.MIN_RIDES_REBALANCING, 0)
CTES["scenario"] = f"""
SELECT *, CASE WHEN imb_score >= 0.25 THEN '#9a031e' WHEN imb_score >= 0.18 THEN '#e36414'
               WHEN imb_score >= 0.10 THEN '#f6bd60' ELSE '#a7c957' END AS hex_colour
FROM ({_list(Q.MIN_RIDES_SCENARIO, 2)})"""
CTES["hotspots"] = f"""
SELECT start_station_name AS station, start_zone AS zone, start_lat AS lat, start_lon AS lon,
       start_nb_docks AS nb_docks, count(*) AS total_rides,
       round(avg(start_station_imbalance_score), 3) AS avg_imbalance_score,
       round(avg(start_station_net_flow), 1) AS avg_net_flow,
       round(count(*) FILTER (WHERE start_station_imbalance_direction = 'draining') / count(*), 6)
         AS pct_days_draining,
       round(count(*) FILTER (WHERE start_station_is_imbalanced) / count(*), 6) AS pct_days_imbalanced
FROM fact GROUP BY ALL HAVING count(*) > {Q.MIN_RIDES_HOTSPOT}"""
CTES["danger"] = """
SELECT *, FALSE AS is_fallback FROM scenario
WHERE priority IN ('CRITICAL', 'HIGH') AND lat IS NOT NULL AND lon IS NOT NULL
UNION ALL
SELECT *, TRUE FROM (SELECT * FROM scenario ORDER BY imb_score DESC, station, imb_direction LIMIT 20)
WHERE NOT EXISTS (SELECT 1 FROM scenario WHERE priority IN ('CRITICAL', 'HIGH'))
  AND lat IS NOT NULL AND lon IS NOT NULL"""
_PICKED = "action IN ('DELIVER BIKES', 'COLLECT BIKES') AND priority IN ('CRITICAL', 'HIGH')"

# --- flow -------------------------------------------------------------------------------------
CTES["station_ends"] = """
SELECT coalesce(d.station_id, a.station_id) AS station_id, coalesce(departures, 0) AS departures,
       coalesce(arrivals, 0) AS arrivals
FROM (SELECT start_station_id AS station_id, count(*) AS departures FROM cycle_hire
      WHERE start_station_id IS NOT NULL GROUP BY 1) d
FULL JOIN (SELECT end_station_id AS station_id, count(*) AS arrivals FROM cycle_hire
      WHERE end_station_id IS NOT NULL GROUP BY 1) a ON d.station_id = a.station_id"""
CTES["flow_scored"] = """
SELECT *, departures - arrivals AS net_flow, departures + arrivals AS total_moves,
       abs(departures - arrivals) / CAST(greatest(departures + arrivals, 1) AS DOUBLE) AS imb_score
FROM station_ends"""
_LEGACY = """CASE WHEN {s} <= 0.1 THEN 'LOW' WHEN {s} <= 0.3 THEN 'MEDIUM' WHEN {s} <= 0.5 THEN 'HIGH'
            ELSE 'CRITICAL' END"""
_OPS = """CASE WHEN {s} <= 0.10 THEN 'LOW' WHEN {s} <= 0.18 THEN 'MEDIUM' WHEN {s} <= 0.25 THEN 'HIGH'
            ELSE 'CRITICAL' END"""
CTES["flow_table"] = f"""
SELECT f.station_id AS start_station_id, departures, arrivals, s.name AS station_name, s.docks_count,
       s.latitude, s.longitude, net_flow, total_moves, imb_score,
       CASE WHEN net_flow > 0 THEN 'Draining' WHEN net_flow < 0 THEN 'Filling' ELSE 'Balanced' END AS direction,
       {_LEGACY.format(s="imb_score")} AS priority
FROM flow_scored f LEFT JOIN cycle_stations s ON f.station_id = s.id"""
CTES["day_flow"] = """
SELECT coalesce(d.hire_date, a.hire_date) AS hire_date, coalesce(d.station_id, a.station_id) AS station_id,
       coalesce(departures, 0) AS departures, coalesce(arrivals, 0) AS arrivals,
       coalesce(departures, 0) - coalesce(arrivals, 0) AS net_flow,
       abs(coalesce(departures, 0) - coalesce(arrivals, 0))
         / CAST(greatest(coalesce(departures, 0) + coalesce(arrivals, 0), 1) AS DOUBLE) AS imb_score
FROM (SELECT CAST(start_date AS DATE) AS hire_date, start_station_id AS station_id, count(*) AS departures
      FROM cycle_hire WHERE start_station_id IS NOT NULL GROUP BY 1, 2) d
FULL JOIN (SELECT CAST(start_date AS DATE) AS hire_date, end_station_id AS station_id, count(*) AS arrivals
      FROM cycle_hire WHERE end_station_id IS NOT NULL GROUP BY 1, 2) a
  ON d.hire_date = a.hire_date AND d.station_id = a.station_id"""
CTES["in_period"] = """
SELECT *, CASE WHEN hour(start_date) IN (7, 8, 9) THEN '{am}' ELSE '{pm}' END AS period
FROM cycle_hire WHERE hour(start_date) IN (7, 8, 9, 17, 18, 19)""".format(am=K.AM_PERIOD, pm=K.PM_PERIOD)
CTES["period_table"] = """
SELECT coalesce(d.period, a.period) AS period, coalesce(d.station_id, a.station_id) AS station_id,
       coalesce(departures, 0) AS departures, coalesce(arrivals, 0) AS arrivals,
       coalesce(departures, 0) - coalesce(arrivals, 0) AS net_flow
FROM (SELECT period, start_station_id AS station_id, count(*) AS departures FROM in_period
      WHERE start_station_id IS NOT NULL GROUP BY 1, 2) d
FULL JOIN (SELECT period, end_station_id AS station_id, count(*) AS arrivals FROM in_period
      WHERE end_station_id IS NOT NULL GROUP BY 1, 2) a
  ON d.period = a.period AND d.station_id = a.station_id"""

# --- exploration ------------------------------------------------------------------------------
CTES["explored"] = """
SELECT *, CAST(start_date AS DATE) AS hire_date, CAST(hour(start_date) AS BIGINT) AS start_hour,
       CAST(isodow(start_date) - 1 AS BIGINT) AS day_of_week, dayname(start_date) AS day_name,
       CAST(month(start_date) AS BIGINT) AS month, isodow(start_date) >= 6 AS is_weekend,
       duration / 60e0 AS duration_minutes,
       CAST(CASE WHEN hour(start_date) IN (7, 8, 17, 18) THEN 1 ELSE 0 END AS BIGINT) AS peak_hour_flag,
       CASE WHEN duration / 60e0 > 0 AND duration / 60e0 <= 10 THEN 'short (<10m)'
            WHEN duration / 60e0 > 10 AND duration / 60e0 <= 30 THEN 'medium (10–30m)'
            WHEN duration / 60e0 > 30 AND duration / 60e0 <= 60 THEN 'long (30–60m)'
            WHEN duration / 60e0 > 60 AND duration / 60e0 <= 1440 THEN 'extended (>60m)' END AS duration_band
FROM cycle_hire"""
CTES["duration_series"] = """
SELECT 'all' AS series, duration_minutes AS v, 80 AS bins FROM explored
UNION ALL
SELECT CASE WHEN is_weekend THEN 'weekend' ELSE 'weekday' END, least(duration_minutes, 90e0), 40 FROM explored"""


def _histogram(series: str, name: str) -> str:
    return f"""
SELECT g.{name}, CAST(g.bin AS BIGINT) AS bin, round(g.low + g.bin * g.width, 6) AS bin_low,
       coalesce(c.n, 0) AS n, round(coalesce(c.n, 0) / (g.total * g.width), 6) AS density
FROM (SELECT {name}, low, width, total, unnest(range(0, bins)) AS bin
      FROM (SELECT {name}, min(v) AS low, count(*) AS total, max(bins) AS bins,
                   (max(v) - min(v)) / max(bins) AS width FROM {series} GROUP BY 1)) g
LEFT JOIN (SELECT s.{name}, least(CAST(floor((s.v - r.low) / r.width) AS BIGINT), s.bins - 1) AS bin,
                  count(*) AS n
           FROM {series} s JOIN (SELECT {name}, min(v) AS low, (max(v) - min(v)) / max(bins) AS width
                                 FROM {series} GROUP BY 1) r ON s.{name} = r.{name}
           GROUP BY 1, 2) c ON g.{name} = c.{name} AND g.bin = c.bin"""


CTES["net_flow_series"] = "SELECT 'net_flow' AS series, CAST(net_flow AS DOUBLE) AS v, 50 AS bins FROM flow_table"

_ML = ", ".join(f"'{d}'" for d in K.ML_HOLIDAYS)
CTES["hourly_counts"] = """
SELECT hire_date, start_station_id, start_hour AS hour, count(*) AS ride_count
FROM stg_rides WHERE start_station_id IS NOT NULL GROUP BY 1, 2, 3"""

ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


# --- warehouse tables ---
oracle("stg_rides", "SELECT * FROM stg_rides")
oracle("stg_stations", "SELECT * FROM stg_stations")
oracle("rides_enriched", "SELECT * FROM rides_enriched")
oracle(
    "station_daily_stats",
    """SELECT * REPLACE (round(avg_duration_mins, 6) AS avg_duration_mins,
       round(utilisation_rate, 6) AS utilisation_rate, round(imbalance_score, 6) AS imbalance_score)
FROM station_daily""",
)
oracle(
    "station_rolling",
    """SELECT hire_date, station_id, total_departures,
       round(rolling_7d_avg_departures, 6) AS rolling_7d_avg_departures FROM station_rolling""",
)
CTES["day_counts"] = "SELECT hire_date, count(*) AS rides FROM stg_rides GROUP BY 1"
oracle(
    "dim_date",
    "SELECT d.*, coalesce(c.rides, 0) AS rides FROM dim_date d LEFT JOIN day_counts c ON d.full_date = c.hire_date",
)
oracle(
    "dim_stations",
    """SELECT * REPLACE (round(avg_imbalance_score_7d, 6) AS avg_imbalance_score_7d,
       round(avg_utilisation_rate_7d, 6) AS avg_utilisation_rate_7d) FROM dim_stations""",
)
oracle("fact_rides", "SELECT * FROM fact_rounded")

# --- mart reports ---
oracle(
    "kpi_summary",
    f"""SELECT count(*) AS total_rides, round(avg(duration_minutes), 1) AS avg_duration,
       round(avg(peak_hour_flag) * 100, 1) AS peak_pct, count(DISTINCT start_station_id) AS n_stations,
       round(count(*) FILTER (WHERE start_station_imbalance_score > 0.2) / count(*) * 100, 1) AS imbalanced_pct
FROM fact WHERE {D}""",
)
oracle("daily_trend", f"SELECT hire_date, count(*) AS rides FROM fact WHERE {D} GROUP BY 1")
oracle("hourly_demand", f"SELECT start_hour, count(*) AS rides FROM fact WHERE {D} GROUP BY 1")
oracle(
    "top_stations",
    f"""SELECT start_station_name, count(*) AS departures FROM fact WHERE {D} GROUP BY 1
ORDER BY departures DESC, start_station_name LIMIT 10""",
)
oracle(
    "imbalanced_station_days",
    """SELECT count(*) AS station_days, count(*) FILTER (WHERE imb_score > 0.2) AS imbalanced_days,
       round(count(*) FILTER (WHERE imb_score > 0.2) / count(*) * 100, 6) AS imbalanced_pct FROM day_flow""",
)
oracle(
    "station_imbalance_recent",
    f"""SELECT start_station_id, start_station_name, start_lat, start_lon,
       round(avg(start_station_imbalance_score), 6) AS avg_imbalance_score, count(*) AS ride_count
FROM fact WHERE hire_date >= DATE '{Q.AS_OF}' - 7 GROUP BY 1, 2, 3, 4""",
)
oracle(
    "hourly_demand_recent",
    f"""SELECT start_hour, day_of_week, is_weekend, count(*) AS ride_count,
       round(avg(duration_minutes), 8) AS avg_duration_mins
FROM fact WHERE hire_date >= DATE '{Q.AS_OF}' - 30 GROUP BY 1, 2, 3""",
)
oracle("rebalancing_list", "SELECT * FROM rebalancing")
oracle("scenario_list", "SELECT * FROM scenario")
oracle("hotspot_profile", "SELECT * FROM hotspots")
oracle(
    "dataset_overview",
    """SELECT min(hire_date) AS earliest_ride, max(hire_date) AS latest_ride,
       date_diff('day', min(hire_date), max(hire_date)) + 1 AS days_covered, count(*) AS total_rides,
       count(DISTINCT start_station_id) AS unique_stations, count(DISTINCT bike_id) AS unique_bikes,
       round(avg(duration_minutes), 1) AS avg_duration_mins,
       count(*) FILTER (WHERE is_weekend) AS weekend_rides,
       CAST(sum(peak_hour_flag) AS BIGINT) AS peak_hour_rides FROM fact""",
)
CTES["months"] = """
SELECT CAST(date_trunc('month', hire_date) AS DATE) AS month, count(*) AS ride_count,
       round(avg(duration_minutes), 1) AS avg_duration,
       round(count(*) FILTER (WHERE is_weekend) / count(*) * 100, 6) AS pct_weekend,
       round(sum(peak_hour_flag) / count(*) * 100, 6) AS pct_peak FROM fact GROUP BY 1"""
oracle("monthly_trend", "SELECT * FROM months")
oracle(
    "hourly_by_weekend",
    """SELECT start_hour, CAST(is_weekend AS BIGINT) AS is_weekend, count(*) AS ride_count,
       round(avg(duration_minutes), 1) AS avg_duration FROM fact GROUP BY 1, 2""",
)
oracle(
    "station_volume_top20",
    """SELECT start_station_name, start_zone, count(*) AS total_departures,
       round(avg(start_station_imbalance_score), 3) AS avg_imbalance_score,
       round(avg(duration_minutes), 1) AS avg_duration_mins,
       round(sum(peak_hour_flag) / count(*) * 100, 6) AS pct_peak_rides
FROM fact GROUP BY 1, 2 ORDER BY total_departures DESC, start_station_name LIMIT 20""",
)
CTES["imbalance_days"] = """
SELECT hire_date, round(avg(start_station_imbalance_score), 4) AS avg_imbalance,
       round(count(*) FILTER (WHERE start_station_is_imbalanced) / count(*), 6) AS pct_rides_imbalanced
FROM fact GROUP BY 1"""
oracle("imbalance_trend", "SELECT * FROM imbalance_days")
CTES["hour_counts"] = "SELECT start_hour, is_weekend, count(*) AS n FROM fact GROUP BY 1, 2"
oracle(
    "trend_extremes",
    """SELECT 'mean_imbalance' AS metric, CAST(NULL AS VARCHAR) AS label, round(avg(avg_imbalance), 6) AS value
FROM imbalance_days
UNION ALL (SELECT 'max_imbalance_day', CAST(hire_date AS VARCHAR), avg_imbalance FROM imbalance_days
           ORDER BY avg_imbalance DESC, hire_date LIMIT 1)
UNION ALL (SELECT 'peak_month', CAST(month AS VARCHAR), ride_count FROM months ORDER BY ride_count DESC, month LIMIT 1)
UNION ALL (SELECT 'trough_month', CAST(month AS VARCHAR), ride_count FROM months ORDER BY ride_count, month LIMIT 1)
UNION ALL (SELECT 'weekday_peak_hour', CAST(start_hour AS VARCHAR), n FROM hour_counts WHERE NOT is_weekend
           ORDER BY n DESC, start_hour LIMIT 1)
UNION ALL (SELECT 'weekend_peak_hour', CAST(start_hour AS VARCHAR), n FROM hour_counts WHERE is_weekend
           ORDER BY n DESC, start_hour LIMIT 1)""",
)
for _column in ("time_period", "duration_band"):
    oracle(
        f"{_column}_counts",
        f"""SELECT {_column}, count(*) AS rides FROM fact WHERE {D} AND duration_minutes BETWEEN 1 AND 120
GROUP BY 1""",
    )
oracle(
    "draining_filling_top10",
    """(SELECT 'draining' AS side, station, zone, avg_net_flow, avg_imbalance_score FROM hotspots
 WHERE avg_net_flow > 0 ORDER BY avg_net_flow DESC, station LIMIT 10)
UNION ALL
(SELECT 'filling', station, zone, avg_net_flow, avg_imbalance_score FROM hotspots
 WHERE avg_net_flow < 0 ORDER BY avg_net_flow, station LIMIT 10)""",
)
oracle(
    "duration_sample",
    f"""SELECT rental_id, duration_minutes, duration_band, is_weekend, peak_hour_flag FROM fact
WHERE {D} AND duration_minutes BETWEEN 1 AND 120""",
)
oracle("recent_rides", f"""SELECT * FROM fact_rounded WHERE hire_date >= DATE '{Q.AS_OF}' - 30""")

# --- flow on raw rides ---
oracle("station_flow", "SELECT * REPLACE (round(imb_score, 6) AS imb_score) FROM flow_table")
oracle("station_day_flow", "SELECT * REPLACE (round(imb_score, 6) AS imb_score) FROM day_flow")
oracle(
    "station_flow_map",
    f"""SELECT s.id, s.name, s.latitude, s.longitude, s.docks_count, coalesce(departures, 0) AS departures,
       coalesce(arrivals, 0) AS arrivals, coalesce(net_flow, 0) AS net_flow, total_moves,
       round(coalesce(imb_score, 0), 6) AS imb_score,
       CASE WHEN net_flow > 0 THEN 'draining' WHEN net_flow < 0 THEN 'filling' ELSE 'balanced' END
         AS imb_direction,
       {_LEGACY.format(s="coalesce(imb_score, 0)")} AS priority
FROM cycle_stations s LEFT JOIN flow_scored f ON s.id = f.station_id""",
)
oracle(
    "station_flow_list",
    f"""SELECT s.name AS station, s.latitude AS lat, s.longitude AS lon, s.docks_count AS nb_docks,
       coalesce(departures, 0) AS departures, coalesce(arrivals, 0) AS arrivals,
       coalesce(net_flow, 0) AS net_flow, coalesce(total_moves, 0) AS total,
       round(coalesce(imb_score, 0), 6) AS imb_score,
       CASE WHEN net_flow > 2 THEN 'DELIVER BIKES' WHEN net_flow < -2 THEN 'COLLECT BIKES'
            ELSE 'MONITOR' END AS action,
       {_OPS.format(s="coalesce(imb_score, 0)")} AS priority
FROM cycle_stations s LEFT JOIN flow_scored f ON s.id = f.station_id""",
)
oracle("period_flow", "SELECT * FROM period_table")
_HOT = """SELECT period, station_id, name AS station_name, departures, arrivals, net_flow,
       abs(net_flow) AS bikes FROM period_table p JOIN cycle_stations s ON p.station_id = s.id"""
oracle(
    "period_hotspots",
    f"""({_HOT} WHERE period LIKE 'AM%' ORDER BY net_flow DESC, station_id LIMIT 15)
UNION ALL ({_HOT} WHERE period LIKE 'PM%' ORDER BY net_flow, station_id LIMIT 15)""",
)
oracle(
    "priority_counts",
    """SELECT 'priority' AS kind, priority AS label, count(*) AS stations FROM flow_table GROUP BY 2
UNION ALL SELECT 'direction', direction, count(*) FROM flow_table GROUP BY 2""",
)
oracle(
    "zone_imbalance",
    f"""SELECT {ZONE_CASE.format(lat="latitude", lon="longitude")} AS zone, count(*) AS stations,
       round(avg(imb_score), 3) AS avg_imbalance,
       count(*) FILTER (WHERE priority = 'CRITICAL') AS critical_count,
       count(*) FILTER (WHERE direction = 'Draining') AS draining_count
FROM flow_table GROUP BY 1""",
)
CTES["network_days"] = """
SELECT hire_date, avg(imb_score) AS imb_score, count(*) AS station_days FROM day_flow GROUP BY 1"""
oracle("network_daily_imbalance", "SELECT * REPLACE (round(imb_score, 6) AS imb_score) FROM network_days")
oracle("network_mean_imbalance", "SELECT round(avg(imb_score), 6) AS mean_imb_score FROM network_days")
oracle(
    "top_imbalanced",
    """SELECT start_station_id, station_name, round(imb_score, 6) AS imb_score, direction
FROM (SELECT * FROM flow_table ORDER BY imb_score DESC, start_station_id LIMIT 20)""",
)

# --- exploration of raw rides ---
oracle(
    "ride_summary",
    """SELECT count(*) AS total_rides, count(DISTINCT start_station_id) AS unique_stations,
       count(DISTINCT bike_id) AS unique_bikes, round(avg(duration_minutes), 6) AS avg_minutes,
       round(median(duration_minutes), 6) AS median_minutes, round(min(duration_minutes), 6) AS min_minutes,
       round(max(duration_minutes), 6) AS max_minutes, round(sum(duration_minutes) / 60, 6) AS total_hours,
       round(avg(peak_hour_flag) * 100, 6) AS peak_pct,
       round(count(*) FILTER (WHERE is_weekend) / count(*) * 100, 6) AS weekend_pct FROM explored""",
)
oracle(
    "eda_duration_bands",
    """SELECT duration_band, count(*) AS rides,
       round(count(*) / (SELECT count(*) FROM explored) * 100, 6) AS pct
FROM explored WHERE duration_band IS NOT NULL GROUP BY 1""",
)
oracle(
    "hourly_profile_pct",
    """SELECT is_weekend, start_hour, count(*) AS rides,
       round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY is_weekend) AS DOUBLE) * 100, 6) AS pct
FROM explored GROUP BY 1, 2""",
)
_DAYS = ", ".join(f"({i}, '{d}')" for i, d in enumerate(K.DAY_NAMES))
oracle(
    "dow_counts",
    f"""SELECT CAST(o.day_order AS BIGINT) AS day_order, o.day_name, count(rental_id) AS rides
FROM (VALUES {_DAYS}) AS o(day_order, day_name) LEFT JOIN explored e ON o.day_name = e.day_name
GROUP BY 1, 2""",
)
oracle(
    "month_counts",
    "SELECT month, strftime(min(start_date), '%b') AS month_label, count(*) AS rides FROM explored GROUP BY 1",
)
_PIVOT = ", ".join(f"count(*) FILTER (WHERE start_hour = {h}) AS h{h:02d}" for h in range(24))
oracle("dow_hour_pivot", f"SELECT day_of_week, {_PIVOT} FROM explored GROUP BY 1")
oracle(
    "peak_offpeak",
    """SELECT peak AS peak_rides, off AS offpeak_rides, round(peak / total * 100, 6) AS peak_pct,
       round(off / total * 100, 6) AS offpeak_pct, round(peak / off, 6) AS peak_ratio,
       round(weekday / weekday_days, 6) AS weekday_rides_per_day,
       round(weekend / weekend_days, 6) AS weekend_rides_per_day,
       round(weekend_minutes - weekday_minutes, 6) AS weekend_extra_minutes
FROM (SELECT count(*) AS total, count(*) FILTER (WHERE peak_hour_flag = 1) AS peak,
             count(*) FILTER (WHERE peak_hour_flag = 0) AS off,
             count(*) FILTER (WHERE NOT is_weekend) AS weekday, count(*) FILTER (WHERE is_weekend) AS weekend,
             count(DISTINCT hire_date) FILTER (WHERE NOT is_weekend) AS weekday_days,
             count(DISTINCT hire_date) FILTER (WHERE is_weekend) AS weekend_days,
             avg(duration_minutes) FILTER (WHERE NOT is_weekend) AS weekday_minutes,
             avg(duration_minutes) FILTER (WHERE is_weekend) AS weekend_minutes FROM explored)""",
)
oracle("duration_histogram", _histogram("duration_series", "series"))
oracle("flow_histogram", _histogram("net_flow_series", "series"))
oracle(
    "key_findings",
    """SELECT 'pct_short' AS metric,
       round(count(*) FILTER (WHERE duration_band = 'short (<10m)') / count(*) * 100, 6) AS value FROM explored
UNION ALL SELECT 'pct_peak', round(avg(peak_hour_flag) * 100, 6) FROM explored
UNION ALL SELECT 'weekend_extra_minutes', round(avg(duration_minutes) FILTER (WHERE is_weekend)
       - avg(duration_minutes) FILTER (WHERE NOT is_weekend), 6) FROM explored
UNION ALL SELECT 'pct_imbalanced', round(count(*) FILTER (WHERE imb_score > 0.2) / count(*) * 100, 6) FROM flow_table
UNION ALL SELECT 'avg_imb_score', round(avg(imb_score), 6) FROM flow_table
UNION ALL SELECT 'n_critical', count(*) FILTER (WHERE priority = 'CRITICAL') FROM flow_table""",
)


def _profile(table: str, types: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS dtype, count(*) - count({c}) AS nulls, "
        f"count(DISTINCT {c}) AS unique_values FROM {table}"
        for c, t in types.items()
    )


_RIDE_TYPES = {
    "rental_id": "bigint",
    "duration": "bigint",
    "bike_id": "bigint",
    "end_date": "timestamp",
    "end_station_id": "bigint",
    "end_station_name": "string",
    "start_date": "timestamp",
    "start_station_id": "bigint",
    "start_station_name": "string",
}
_STATION_TYPES = {
    "id": "bigint",
    "installed": "boolean",
    "locked": "boolean",
    "install_date": "date",
    "name": "string",
    "terminal_name": "string",
    "latitude": "double",
    "longitude": "double",
    "docks_count": "bigint",
    "temporary": "boolean",
}
oracle("profile_rides", _profile("cycle_hire", _RIDE_TYPES))
oracle("profile_stations", _profile("cycle_stations", _STATION_TYPES))
oracle(
    "rider_features",
    """SELECT rental_id, round(duration_minutes, 6) AS duration_minutes, start_hour, is_weekend, peak_hour_flag,
       day_of_week,
       CAST(start_hour IN (7, 8, 9, 17, 18, 19) AS BIGINT) AS is_commuter_hour,
       CAST(start_hour IN (10, 11, 12, 13, 14, 15, 16) AS BIGINT) AS is_leisure_hour,
       CAST(start_hour IN (20, 21, 22, 23, 0, 1, 2) AS BIGINT) AS is_night FROM explored""",
)
oracle(
    "rule_segments",
    """SELECT CASE WHEN is_weekend THEN 'Leisure' WHEN peak_hour_flag = 1 THEN 'Commuter' ELSE 'Casual' END AS segment,
       count(*) AS rides, round(count(*) / (SELECT count(*) FROM fact) * 100, 6) AS pct FROM fact GROUP BY 1""",
)


oracle(
    "segment_points_k4",
    """SELECT round(duration_minutes, 6) AS duration_minutes, CAST(is_weekend AS DOUBLE) AS is_weekend,
       CAST(peak_hour_flag AS DOUBLE) AS peak_hour_flag,
       CAST(start_hour IN (7, 8, 9, 17, 18, 19) AS DOUBLE) AS is_commuter_hour,
       CAST(start_hour IN (10, 11, 12, 13, 14, 15, 16) AS DOUBLE) AS is_leisure_hour,
       CAST(start_hour IN (20, 21, 22, 23, 0, 1, 2) AS DOUBLE) AS is_night, count(*) AS n_rides
FROM explored GROUP BY ALL""",
)
oracle(
    "segment_points_k3",
    f"""SELECT duration_minutes, CAST(start_hour AS DOUBLE) AS start_hour, CAST(is_weekend AS DOUBLE) AS is_weekend,
       CAST(peak_hour_flag AS DOUBLE) AS peak_hour_flag, count(*) AS n_rides
FROM fact WHERE {D} AND duration_minutes BETWEEN 1 AND 120 GROUP BY ALL""",
)

# --- segments by given centres ---
CTES["rider_points"] = """
SELECT duration_minutes, CAST(is_weekend AS DOUBLE) AS is_weekend, CAST(peak_hour_flag AS DOUBLE) AS peak_hour_flag,
       CAST(start_hour IN (7, 8, 9, 17, 18, 19) AS DOUBLE) AS is_commuter_hour,
       CAST(start_hour IN (10, 11, 12, 13, 14, 15, 16) AS DOUBLE) AS is_leisure_hour,
       CAST(start_hour IN (20, 21, 22, 23, 0, 1, 2) AS DOUBLE) AS is_night FROM explored"""
CTES["mart_points"] = f"""
SELECT duration_minutes, CAST(start_hour AS DOUBLE) AS start_hour, CAST(is_weekend AS DOUBLE) AS is_weekend,
       CAST(peak_hour_flag AS DOUBLE) AS peak_hour_flag FROM fact WHERE {D} AND duration_minutes BETWEEN 1 AND 120"""


def _nearest(points: str, features: tuple[str, ...], centres: list) -> str:
    """Every ride with the nearest centre, distances in deviations of the features."""
    deviations = ", ".join(f"coalesce(nullif(stddev_pop({c}), 0), 1) AS s_{c}" for c in features)
    distances = ", ".join(
        "(" + " + ".join(f"(({c} - {float(at)}) / s_{c}) ** 2" for c, at in zip(features, centre)) + ")"
        for centre in centres
    )
    return f"""
SELECT p.*, list_position(d, list_min(d)) - 1 AS cluster
FROM (SELECT *, [{distances}] AS d FROM {points}, (SELECT {deviations} FROM {points}) s) p"""


CTES["assigned_4"] = _nearest("rider_points", RIDER_SPEC.features, Q.CENTRES_4)
CTES["assigned_3"] = _nearest("mart_points", MART_SPEC.features, Q.CENTRES_3)


def _segment_profile(assigned: str, features: tuple[str, ...], digits: int, label: str) -> str:
    means = ", ".join(f"round(avg({c}), {digits}) AS {c}" for c in features)
    return f"""
SELECT *, {label} AS label FROM (
  SELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS ride_count, {means},
         round(count(*) / (SELECT count(*) FROM {assigned}) * 100, 1) AS pct_of_total FROM {assigned} GROUP BY 1)"""


_c, _l, _m, _e = K.SEGMENTS_4
CTES["profile_4"] = _segment_profile(
    "assigned_4",
    RIDER_SPEC.features,
    3,
    f"""CASE WHEN is_commuter_hour > 0.5 AND is_weekend < 0.25 THEN '{_c}' WHEN is_weekend > 0.4 THEN '{_l}'
       WHEN is_leisure_hour > 0.5 THEN '{_m}' ELSE '{_e}' END""",
)
_c3, _l3, _o3 = K.SEGMENTS_3
CTES["profile_3"] = _segment_profile(
    "assigned_3",
    MART_SPEC.features,
    2,
    f"CASE WHEN peak_hour_flag > 0.35 THEN '{_c3}' WHEN is_weekend > 0.4 THEN '{_l3}' ELSE '{_o3}' END",
)
CTES["labelled_4"] = "SELECT a.*, p.label FROM assigned_4 a JOIN profile_4 p USING (cluster)"
CTES["labelled_3"] = "SELECT a.*, p.label FROM assigned_3 a JOIN profile_3 p USING (cluster)"
CTES["segment_minutes"] = "SELECT label, duration_minutes AS v, 40 AS bins FROM labelled_3"
CTES["mart_minutes"] = f"""
SELECT 'rides' AS series, duration_minutes AS v, 60 AS bins FROM fact
WHERE {D} AND duration_minutes BETWEEN 1 AND 120"""
CTES["mart_bins"] = _histogram("mart_minutes", "series")
oracle("given_profile_k4", "SELECT * FROM profile_4")
_names = ", ".join(RIDER_SPEC.features)
_gaps = " + ".join(
    f"power(CASE WHEN s.{c} = 0 THEN 0 ELSE (a.{c} - b.{c}) / s.{c} END, 2)" for c in RIDER_SPEC.features
)
CTES["points_4"] = f"SELECT {_names}, cluster, count(*) AS n FROM assigned_4 GROUP BY ALL"
CTES["scales_4"] = "SELECT " + ", ".join(f"stddev_pop({c}) AS {c}" for c in RIDER_SPEC.features) + " FROM assigned_4"
CTES["reach_4"] = f"""
SELECT {", ".join(f"a.{c}" for c in RIDER_SPEC.features)}, a.cluster, a.n, b.cluster AS other,
       sum(sqrt({_gaps}) * b.n) AS distance, sum(b.n) AS rides
FROM points_4 a CROSS JOIN points_4 b CROSS JOIN scales_4 s GROUP BY ALL"""
CTES["means_4"] = f"""
SELECT {_names}, cluster, n,
       max(CASE WHEN other = cluster AND rides > 1 THEN distance / (rides - 1) END) AS a,
       min(CASE WHEN other <> cluster THEN distance / rides END) AS b
FROM reach_4 GROUP BY ALL"""
CTES["silhouettes_4"] = """
SELECT cluster, n, CASE WHEN a IS NULL OR b IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END AS s
FROM means_4"""
oracle(
    "given_silhouette_k4",
    """SELECT CAST(cluster AS INTEGER) AS cluster, CAST(sum(n) AS BIGINT) AS ride_count,
       round(sum(s * n) / sum(n), 6) AS silhouette,
       round((SELECT sum(s * n) / sum(n) FROM silhouettes_4), 6) AS silhouette_all
FROM silhouettes_4 GROUP BY 1""",
)
oracle("given_profile_k3", "SELECT * FROM profile_3")
oracle(
    "given_hours_k3",
    """SELECT label, start_hour, count(*) AS rides,
       round(count(*) / sum(count(*)) OVER (PARTITION BY label) * 100, 6) AS pct FROM labelled_3 GROUP BY 1, 2""",
)
oracle("given_durations_k3", _histogram("segment_minutes", "label"))
oracle("given_weekend_k4", "SELECT label, round(avg(is_weekend) * 100, 6) AS weekend_pct FROM labelled_4 GROUP BY 1")
oracle(
    "key_findings_commuters",
    ORACLE["key_findings"]
    + """
UNION ALL SELECT 'pct_commuter', round(count(*) FILTER (WHERE contains(label, 'Commuter')) / count(*) * 100, 6)
FROM labelled_4""",
)
oracle(
    "mart_durations",
    """SELECT bin, bin_low, n, (SELECT round(median(v), 6) FROM mart_minutes) AS median,
       (SELECT round(avg(v), 6) FROM mart_minutes) AS mean FROM mart_bins""",
)


# --- data quality ---
def _check(point: str, check_id: str, name: str, value: str, rule: str = "= 0",
           threshold: str = "NULL", severity: str = "error") -> str:
    bad = "FAIL" if severity == "error" else "WARN"
    return f"""SELECT '{point}' AS checkpoint, '{check_id}' AS check_id, '{name}' AS "check",
  CASE WHEN ({value}) {rule} THEN 'PASS' ELSE '{bad}' END AS status,
  round(CAST(({value}) AS DOUBLE), 6) AS value, CAST({threshold} AS DOUBLE) AS threshold,
  '{severity}' AS severity"""


def _where(table: str, condition: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE {condition}"


def _dupes(table: str, key: str) -> str:
    return f"SELECT count(*) - count(DISTINCT {key}) FROM {table}"


def _checks(rows: list[tuple]) -> str:
    return "\nUNION ALL ".join(_check(*row) for row in rows)


_IN, _TR, _FI = "post_ingest", "post_transform", "files"
_LAT, _LON = "latitude < 51.3 OR latitude > 51.7", "longitude < -0.6 OR longitude > 0.3"
oracle(
    "quality_post_ingest",
    _checks(
        [
            (_IN, "Q01", "rental_id not null", _where("cycle_hire", "rental_id IS NULL")),
            (_IN, "Q02", "rental_id unique", _dupes("cycle_hire", "rental_id")),
            (_IN, "Q03", "start_date not null", _where("cycle_hire", "start_date IS NULL")),
            (_IN, "Q04", "start_date from 2010 on", _where("cycle_hire", "start_date < TIMESTAMP '2010-01-01'")),
            (_IN, "Q05", "duration not null", _where("cycle_hire", "duration IS NULL")),
            (_IN, "Q06", "duration within 60 to 86400 seconds",
             _where("cycle_hire", "duration < 60 OR duration > 86400"), "= 0", "NULL", "warning"),
            (_IN, "Q07", "start_station_id not null", _where("cycle_hire", "start_station_id IS NULL")),
            (_IN, "Q08", "end_station_id not null", _where("cycle_hire", "end_station_id IS NULL"),
             "= 0", "NULL", "warning"),
            (_IN, "Q09", "end_date after start_date", _where("cycle_hire", "end_date <= start_date"),
             "= 0", "NULL", "warning"),
            (_IN, "Q10", "enough rides", "SELECT count(*) FROM cycle_hire", f">= {Q.MIN_ROWS}", f"{Q.MIN_ROWS}"),
            (_IN, "Q11", "station id not null", _where("cycle_stations", "id IS NULL")),
            (_IN, "Q12", "station id unique", _dupes("cycle_stations", "id")),
            (_IN, "Q13", "latitude in service area", _where("cycle_stations", _LAT)),
            (_IN, "Q14", "longitude in service area", _where("cycle_stations", _LON)),
            (_IN, "Q15", "docks positive", _where("cycle_stations", "docks_count <= 0")),
            (_IN, "Q16", "station name not null", _where("cycle_stations", "name IS NULL")),
        ]
    ),
)
_NULL_CELLS = """SELECT (count(*) FILTER (WHERE start_station_name IS NULL)
  + count(*) FILTER (WHERE hire_date IS NULL) + count(*) FILTER (WHERE duration_minutes IS NULL))
  / (count(*) * 3e0) FROM fact"""
_ORPHANS = """SELECT count(DISTINCT f.start_station_id) FROM fact f
  LEFT JOIN dim_stations s ON f.start_station_id = s.station_id WHERE s.station_id IS NULL"""
oracle(
    "quality_post_transform",
    _checks(
        [
            (_TR, "Q17", "rental_id not null", _where("fact", "rental_id IS NULL")),
            (_TR, "Q18", "ride_sk unique", _dupes("fact", "ride_sk")),
            (_TR, "Q19", "duration_minutes within 1 to 1440",
             _where("fact", "duration_minutes < 1 OR duration_minutes > 1440")),
            (_TR, "Q20", "start_station_id not null", _where("fact", "start_station_id IS NULL")),
            (_TR, "Q21", "hire_date not null", _where("fact", "hire_date IS NULL")),
            (_TR, "Q22", "start_hour within 0 to 23", _where("fact", "start_hour < 0 OR start_hour > 23")),
            (_TR, "Q23", "duration_band known",
             _where("fact", "duration_band NOT IN ('short', 'medium', 'long', 'extended')")),
            (_TR, "Q24", "NULL rate of key columns", _NULL_CELLS, "< 0.05", "0.05", "warning"),
            (_TR, "Q25", "end after start", _where("fact", "end_datetime <= start_datetime")),
            (_TR, "Q26", "imbalance score within 0 to 1",
             _where("fact", "start_station_imbalance_score < 0 OR start_station_imbalance_score > 1")),
            (_TR, "Q27", "enough rides", "SELECT count(*) FROM fact", f">= {Q.MIN_ROWS}", f"{Q.MIN_ROWS}"),
            (_TR, "Q28", "station_id not null", _where("dim_stations", "station_id IS NULL")),
            (_TR, "Q29", "station_id unique", _dupes("dim_stations", "station_id")),
            (_TR, "Q30", "latitude plausible", _where("dim_stations", "latitude < 51.0 OR latitude > 52.0")),
            (_TR, "Q31", "docks positive", _where("dim_stations", "nb_docks <= 0")),
            (_TR, "Q32", "start stations known", _ORPHANS, "= 0", "NULL", "warning"),
            (_TR, "Q33", "enough days", "SELECT count(*) FROM dim_date", ">= 3650", "3650"),
            (_TR, "Q34", "date_id unique", _dupes("dim_date", "date_id")),
        ]
    ),
)
_RIDES, _STATIONS = "cycle_hire", "cycle_stations"


def _not(condition: str) -> str:
    return f"NOT coalesce({condition}, FALSE)"


oracle(
    "quality_files",
    _checks(
        [
            (_FI, "F01", "rental_id not null", _where(_RIDES, "rental_id IS NULL")),
            (_FI, "F02", "bike_id not null", _where(_RIDES, "bike_id IS NULL")),
            (_FI, "F03", "start_date not null", _where(_RIDES, "start_date IS NULL")),
            (_FI, "F04", "start_station_id not null", _where(_RIDES, "start_station_id IS NULL")),
            (_FI, "F05", "duration positive", _where(_RIDES, _not("duration > 0"))),
            (_FI, "F06", "station id not null", _where(_STATIONS, "id IS NULL")),
            (_FI, "F07", "station name not null", _where(_STATIONS, "name IS NULL")),
            (_FI, "F08", "docks positive", _where(_STATIONS, _not("docks_count > 0"))),
            (_FI, "F09", "rental_id unique", _dupes(_RIDES, "rental_id")),
            (_FI, "F10", "station id unique", _dupes(_STATIONS, "id")),
            (_FI, "F11", "latitude in service area", _where(_STATIONS, _not("latitude BETWEEN 51.3 AND 51.7"))),
            (_FI, "F12", "longitude in service area", _where(_STATIONS, _not("longitude BETWEEN -0.6 AND 0.3"))),
            (_FI, "F13", "enough rides", f"SELECT count(*) FROM {_RIDES}", ">= 1000", "1000"),
            (_FI, "F14", "enough stations", f"SELECT count(*) FROM {_STATIONS}", ">= 100", "100"),
            (_FI, "G04", "duration within 60 to 86400 seconds",
             _where(_RIDES, _not("duration BETWEEN 60 AND 86400"))),
            (_FI, "G05", "end_station_id not null", _where(_RIDES, "end_station_id IS NULL")),
            (_FI, "G06", "end after start", _where(_RIDES, _not("end_date > start_date"))),
        ]
    ),
)


def _test(model: str, table: str, column: str, kind: str, detail: str = "", severity: str = "error") -> str:
    failing = {
        "not_null": _where(table, f"{column} IS NULL"),
        "accepted_range": _where(table, f"NOT ({column} BETWEEN {detail})"),
        "accepted_values": _where(table, f"{column} NOT IN ({detail})"),
        "unique": f"SELECT count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
        "GROUP BY 1 HAVING count(*) > 1)",
        "relationships": f"SELECT count(*) FROM {table} c WHERE {column} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {detail} p WHERE p.station_id = c.{column})",
    }[kind]
    bad = "WARN" if severity == "warn" else "ERROR"
    return f"""SELECT '{model}' AS model, '{column}' AS column_name, '{kind}' AS test,
  '{severity}' AS severity, ({failing}) AS failures,
  CASE WHEN ({failing}) = 0 THEN 'PASS' ELSE '{bad}' END AS status"""


def _tests(rows: list[tuple]) -> str:
    return "\nUNION ALL ".join(_test(*row) for row in rows)


def _many(model: str, table: str, kind: str, columns: str) -> list[tuple]:
    return [(model, table, c, kind) for c in columns.split()]


def _texts(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


_ZONES = [box[0] for box in K.ZONE_BOXES] + ["Other"]
oracle(
    "schema_tests_staging",
    _tests(
        [
            *_many("cycle_hire", "cycle_hire", "not_null", "rental_id duration start_date start_station_id"),
            ("cycle_hire", "cycle_hire", "rental_id", "unique"),
            ("cycle_hire", "cycle_hire", "end_station_id", "not_null", "", "warn"),
            *_many("cycle_stations", "cycle_stations", "not_null", "id docks_count latitude longitude"),
            ("cycle_stations", "cycle_stations", "id", "unique"),
            *_many("stg_cycle_hire", "stg_rides", "not_null",
                   "rental_id duration_seconds start_station_id start_datetime hire_date is_weekend"),
            ("stg_cycle_hire", "stg_rides", "rental_id", "unique"),
            ("stg_cycle_hire", "stg_rides", "duration_seconds", "accepted_range", "60 AND 86400"),
            ("stg_cycle_hire", "stg_rides", "end_station_id", "not_null", "", "warn"),
            *_many("stg_cycle_stations", "stg_stations", "not_null", "station_id nb_docks zone capacity_tier"),
            ("stg_cycle_stations", "stg_stations", "station_id", "unique"),
            ("stg_cycle_stations", "stg_stations", "nb_docks", "accepted_range", "1 AND 100"),
            ("stg_cycle_stations", "stg_stations", "latitude", "accepted_range", "51.3 AND 51.7"),
            ("stg_cycle_stations", "stg_stations", "longitude", "accepted_range", "-0.6 AND 0.3"),
            ("stg_cycle_stations", "stg_stations", "zone", "accepted_values", _texts(_ZONES)),
            ("stg_cycle_stations", "stg_stations", "capacity_tier", "accepted_values",
             "'small', 'medium', 'large'"),
        ]
    ),
)
oracle(
    "schema_tests_marts",
    _tests(
        [
            *_many("fact_rides", "fact", "not_null",
                   "ride_sk rental_id hire_date duration_minutes peak_hour_flag "
                   "start_station_is_imbalanced start_station_id"),
            *_many("fact_rides", "fact", "unique", "ride_sk rental_id"),
            ("fact_rides", "fact", "duration_minutes", "accepted_range", "1 AND 1440"),
            ("fact_rides", "fact", "peak_hour_flag", "accepted_range", "0 AND 1"),
            ("fact_rides", "fact", "start_station_id", "relationships", "dim_stations", "warn"),
            ("fact_rides", "fact", "duration_band", "accepted_values", "'short', 'medium', 'long', 'extended'"),
            *_many("dim_stations", "dim_stations", "not_null",
                   "station_sk station_id zone rebalancing_priority nb_docks"),
            *_many("dim_stations", "dim_stations", "unique", "station_sk station_id"),
            ("dim_stations", "dim_stations", "rebalancing_priority", "accepted_values",
             "'CRITICAL', 'HIGH', 'MEDIUM', 'LOW'"),
            ("dim_stations", "dim_stations", "nb_docks", "accepted_range", "1 AND 100"),
            *_many("dim_date", "dim_date", "not_null", "date_id full_date is_weekend"),
            *_many("dim_date", "dim_date", "unique", "date_id full_date"),
            ("dim_date", "dim_date", "season", "accepted_values", "'spring', 'summer', 'autumn', 'winter'"),
        ]
    ),
)
oracle(
    "assert_ride_duration",
    """SELECT rental_id, start_datetime, end_datetime, duration_seconds FROM fact
WHERE end_datetime <= start_datetime OR duration_seconds <= 0""",
)
oracle(
    "assert_raw_duration",
    """SELECT rental_id, start_date AS start_datetime, end_date AS end_datetime, duration AS duration_seconds
FROM cycle_hire WHERE end_date <= start_date OR duration <= 0""",
)
oracle(
    "fk_orphans",
    """SELECT start_station_id AS "key", count(*) AS "rows" FROM fact f
WHERE NOT EXISTS (SELECT 1 FROM dim_stations s WHERE s.station_id = f.start_station_id)
  AND start_station_id IS NOT NULL GROUP BY 1""",
)

# --- planning ---
oracle(
    "dispatch_list",
    f"""SELECT station, priority, action, imb_score, net_flow, nb_docks,
       CAST(trunc(net_flow) AS BIGINT) AS bikes_per_day, coalesce(nb_docks, 0) AS docks
FROM scenario WHERE {_PICKED}""",
)
oracle("danger_zone", "SELECT * FROM danger")
oracle(
    "station_at_point",
    f"SELECT * FROM scenario WHERE round(lat, 4) = round({Q.POINT[0]}e0, 4) AND round(lon, 4) = round({Q.POINT[1]}e0, 4)",
)
CTES["markers"] = """
SELECT station_id AS id, station_name AS name, zone, latitude, longitude, nb_docks AS nbdocks,
       rebalancing_priority AS priority, avg_imbalance_score_7d AS imb_score,
       total_departures_all_time AS departures, total_arrivals_all_time AS arrivals,
       total_departures_all_time - total_arrivals_all_time AS net_flow,
       CASE WHEN total_departures_all_time > total_arrivals_all_time THEN 'draining'
            WHEN total_departures_all_time < total_arrivals_all_time THEN 'filling'
            ELSE 'balanced' END AS imb_direction
FROM dim_stations"""


def _colour(*values) -> str:
    a, b, c, d = (f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    text = f"CASE WHEN imb_score < 0.1 THEN {a} WHEN imb_score < 0.3 THEN {b} WHEN imb_score < 0.5 THEN {c} ELSE {d} END"
    return text if isinstance(values[0], str) else f"CAST({text} AS BIGINT)"


oracle(
    "station_map",
    f"""SELECT * REPLACE (round(imb_score, 6) AS imb_score),
       upper(imb_direction[1]) || imb_direction[2:] AS direction_label,
       printf('%+d', net_flow) AS net_flow_label,
       {_colour("#22C55E", "#EAB308", "#F97316", "#EF4444")} AS hex_colour,
       {_colour(34, 234, 249, 239)} AS red, {_colour(197, 179, 115, 68)} AS green,
       {_colour(94, 8, 22, 68)} AS blue, round(least(imb_score * 200 + 60, 300e0), 6) AS radius FROM markers""",
)
oracle(
    "station_map_filtered",
    ORACLE["station_map"] + " WHERE priority IN ('CRITICAL', 'HIGH') AND imb_direction IN ('draining', 'filling')",
)
oracle(
    "map_summary",
    """SELECT count(*) AS stations, count(*) FILTER (WHERE priority = 'CRITICAL') AS critical,
       count(*) FILTER (WHERE imb_direction = 'draining') AS draining FROM markers""",
)
oracle(
    "map_centre",
    """SELECT round(coalesce(avg(lat), 51.508e0), 6) AS centre_lat,
       round(coalesce(avg(lon), -0.128e0), 6) AS centre_lon FROM danger""",
)


def _crew(plan: str) -> str:
    return f"""SELECT '{plan}' AS plan, count(*) FILTER (WHERE priority = 'CRITICAL') AS n_critical,
       count(*) FILTER (WHERE priority = 'HIGH') AS n_high, count(*) FILTER (WHERE {_PICKED}) AS n_action,
       count(*) FILTER (WHERE {_PICKED} AND action = 'DELIVER BIKES') AS n_deliver,
       count(*) FILTER (WHERE {_PICKED} AND action = 'COLLECT BIKES') AS n_collect,
       CAST(greatest(1, round_even(count(*) FILTER (WHERE {_PICKED}) / 15e0, 0)) AS BIGINT) AS crew_runs
FROM {plan}"""


oracle("crew_plan", f"{_crew('rebalancing')}\nUNION ALL {_crew('scenario')}")
oracle(
    "action_statement",
    f"""SELECT count(*) AS stations, count(*) FILTER (WHERE action = 'DELIVER BIKES') AS deliveries,
       count(*) FILTER (WHERE action = 'COLLECT BIKES') AS collections,
       CAST(greatest(1, round_even(count(*) / 15e0, 0)) AS BIGINT) AS crew_runs, max(imb_score) AS worst_score,
       CASE WHEN count(*) = 0 THEN 'all clear' WHEN max(imb_score) >= 0.40 THEN 'immediately'
            WHEN max(imb_score) >= 0.25 THEN 'urgently' ELSE 'today' END AS urgency,
       CAST(CASE WHEN count(*) = 0 THEN NULL WHEN max(imb_score) >= 0.40 THEN 2
            WHEN max(imb_score) >= 0.25 THEN 4 ELSE 6 END AS BIGINT) AS within_hours
FROM scenario WHERE {_PICKED}""",
)
_WAIT = (7 - Q.NOW_HOUR) % 24
oracle(
    "dispatch_recommendation",
    f"""SELECT station, imb_direction, action, CAST(7 AS BIGINT) AS next_peak_hour, '07:00' AS next_peak_label,
       CAST({_WAIT} AS BIGINT) AS hours_to_peak, CAST({max(1, _WAIT - 1)} AS BIGINT) AS dispatch_window,
       CAST(greatest(1, round_even(abs(net_flow), 0)) AS BIGINT) AS bikes_needed
FROM scenario WHERE action <> 'MONITOR'""",
)
_WEIGHTS = ", ".join(f"({h}, {w}e0)" for h, w in enumerate(K.HOUR_WEIGHTS))
CTES["volumes"] = "SELECT start_station_id, count(*) AS volume FROM stg_rides WHERE start_station_id IS NOT NULL GROUP BY 1"
CTES["fallback"] = f"""
SELECT s.station_id, CAST(w.hour AS BIGINT) AS hour,
       w.weight * least(greatest(coalesce(v.volume, 0) / (SELECT avg(volume) FROM volumes), 0.5e0), 2e0) * 4.5e0 AS p
FROM stg_stations s LEFT JOIN volumes v ON s.station_id = v.start_station_id
CROSS JOIN (VALUES {_WEIGHTS}) AS w(hour, weight)"""
oracle(
    "forecast_fallback",
    """SELECT station_id, hour, round_even(p, 1) AS forecast, round_even(p - p * 0.25e0, 1) AS lower_ci,
       round_even(p + p * 0.25e0, 1) AS upper_ci, hour IN (7, 8, 17, 18) AS is_peak FROM fallback""",
)

oracle(
    "forecast_fallback_totals",
    """SELECT station_id, round(sum(f), 6) AS total_24h,
       round(sum(CASE WHEN hour IN (7, 8, 17, 18) THEN f ELSE 0 END), 6) AS peak_total,
       round(sum(CASE WHEN hour IN (7, 8, 17, 18) THEN 0 ELSE f END), 6) AS offpeak_total,
       min(CASE WHEN hour IN (7, 8, 17, 18) THEN hour END) AS next_peak_hour
FROM (SELECT station_id, hour, round_even(p, 1) AS f FROM fallback) GROUP BY 1""",
)

# --- demand features ---
oracle(
    "demand_features",
    f"""SELECT hire_date, hour, CAST(dayofweek(hire_date) + 1 AS BIGINT) AS day_of_week,
       CAST(dayofweek(hire_date) IN (0, 6) AS BIGINT) AS is_weekend,
       CAST(CAST(hire_date AS VARCHAR) IN ({_ML}) AS BIGINT) AS is_holiday,
       CAST(CASE WHEN month(hire_date) IN (12, 1, 2) THEN 0 WHEN month(hire_date) IN (3, 4, 5) THEN 1
            WHEN month(hire_date) IN (6, 7, 8) THEN 2 ELSE 3 END AS BIGINT) AS season, start_station_id,
       round(coalesce(avg(ride_count) OVER (PARTITION BY start_station_id, hour ORDER BY hire_date
             ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0), 6) AS rolling_7d_avg, ride_count
FROM hourly_counts""",
)
oracle(
    "trailing_demand",
    f"""SELECT start_station_id, hour, round(avg(ride_count), 6) AS rolling_7d_avg
FROM (SELECT *, row_number() OVER (PARTITION BY start_station_id, hour ORDER BY hire_date DESC) AS age
      FROM hourly_counts WHERE hire_date < DATE '{Q.AS_OF}') WHERE age <= 7 GROUP BY 1, 2""",
)

CTES["demand_rows"] = f"""
SELECT hire_date, hour, start_station_id, ride_count,
       coalesce(avg(ride_count) OVER (PARTITION BY start_station_id, hour ORDER BY hire_date
                ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0) AS mean_before,
       substring(md5(CAST(hire_date AS VARCHAR) || '|' || CAST(start_station_id AS VARCHAR) || '|'
                     || CAST(hour AS VARCHAR)), 1, 2) < 'cd' AS trains
FROM hourly_counts"""
oracle("demand_split", "SELECT hire_date, start_station_id, hour, trains FROM demand_rows")
oracle(
    "baseline_scores",
    """SELECT 'Trailing mean' AS model, round(sqrt(avg((ride_count - mean_before) ** 2)), 6) AS rmse,
       round(avg(abs(ride_count - mean_before)), 6) AS mae,
       round(1 - avg((ride_count - mean_before) ** 2) / var_pop(ride_count), 6) AS r2, count(*) AS test_rows
FROM demand_rows WHERE NOT trains""",
)
CTES["recent_demand"] = f"""
SELECT start_station_id, hour, avg(ride_count) AS mean_rides
FROM (SELECT *, row_number() OVER (PARTITION BY start_station_id, hour ORDER BY hire_date DESC) AS age
      FROM hourly_counts WHERE hire_date < DATE '{Q.AS_OF}') WHERE age <= 7 GROUP BY 1, 2"""
oracle(
    "serving_features",
    f"""SELECT DATE '{Q.AS_OF}' AS hire_date, h.hour, CAST(dayofweek(DATE '{Q.AS_OF}') + 1 AS BIGINT) AS day_of_week,
       CAST(dayofweek(DATE '{Q.AS_OF}') IN (0, 6) AS BIGINT) AS is_weekend,
       CAST('{Q.AS_OF}' IN ({_ML}) AS BIGINT) AS is_holiday, CAST(0 AS BIGINT) AS season,
       s.station_id AS start_station_id, round(coalesce(r.mean_rides, 0), 6) AS rolling_7d_avg
FROM stg_stations s CROSS JOIN (SELECT unnest(range(24)) AS hour) h
LEFT JOIN recent_demand r ON r.start_station_id = s.station_id AND r.hour = h.hour""",
)
oracle(
    "training_extract",
    """SELECT rental_id, start_datetime, duration_seconds, start_station_id, hire_date, start_hour, day_of_week,
       is_weekend, peak_hour_flag FROM fact WHERE hire_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'""",
)

# --- sources ---
oracle("high_water_mark", "SELECT max(start_date) AS high_water FROM cycle_hire")
oracle("accepted_records", "SELECT * FROM cycle_hire WHERE end_station_id IS NOT NULL")
oracle(
    "extract_stations",
    """SELECT id, installed, locked, install_date, name, terminal_name, latitude, longitude, docks_count,
       temporary FROM cycle_stations""",
)
oracle(
    "incremental_extract",
    f"""SELECT * FROM cycle_hire
WHERE start_date > TIMESTAMP '{Q.INCREMENT_AFTER}' AND start_date <= TIMESTAMP '{Q.INCREMENT_UNTIL}'""",
)
oracle(
    "rejected_records",
    """SELECT CAST(rental_id AS VARCHAR) AS rental_id, CAST(duration AS VARCHAR) AS duration,
       CAST(bike_id AS VARCHAR) AS bike_id, 'unknown' AS end_station_id,
       CAST(start_station_id AS VARCHAR) AS start_station_id, 'end_station_id' AS rejected_for
FROM cycle_hire WHERE end_station_id IS NULL""",
)

# --- sinks that must give back what was written ---
oracle("csv_roundtrip", "SELECT * FROM cycle_hire")
oracle("load_raw", "SELECT *, CAST(1 AS BIGINT) AS _sdc_table_version, TRUE AS has_receipt FROM cycle_hire")
oracle("write_fact", "SELECT * FROM fact_rounded")
oracle(
    "write_dims",
    """SELECT 'dim_date' AS table_name, date_id, day_name AS name, season AS kind FROM dim_date
UNION ALL SELECT 'dim_stations', station_id, station_name, rebalancing_priority FROM dim_stations""",
)
oracle(
    "export_dispatch",
    f"""SELECT station, priority, action, imb_score, net_flow, nb_docks,
       CAST(trunc(net_flow) AS BIGINT) AS bikes_per_day, coalesce(nb_docks, 0) AS docks
FROM rebalancing WHERE {_PICKED}""",
)
oracle("stream_incremental", "SELECT * FROM cycle_hire")
# The window bounds of parity.registry.
CTES["bookmarked"] = """
SELECT *, CAST(CASE WHEN start_date <= TIMESTAMP '2024-01-15 00:00:00' THEN 0
                    WHEN start_date <= TIMESTAMP '2024-01-22 12:00:00' THEN 1 ELSE 2 END AS BIGINT) AS batch_id
FROM cycle_hire"""
oracle("bookmark_loads", "SELECT * FROM bookmarked")
oracle(
    "load_history",
    """SELECT 'daily' AS load, batch_id, count(*) AS rides, min(start_date) AS first_start,
       max(start_date) AS last_start FROM bookmarked GROUP BY batch_id""",
)
oracle(
    "stream_station_days",
    """SELECT hire_date, start_station_id AS station_id, start_station_name AS station_name,
       hire_date + INTERVAL 1 DAY <= (SELECT max(start_datetime) FROM stg_rides) - INTERVAL 7 DAY AS is_closed,
       count(*) AS total_departures, CAST(sum(peak_hour_flag) AS BIGINT) AS peak_departures,
       round(sum(duration_minutes), 6) AS sum_minutes
FROM rides_enriched GROUP BY ALL""",
)
oracle(
    "refreshed_station_days",
    f"""SELECT d.*, r.rolling_7d_avg_departures FROM ({ORACLE["station_daily_stats"]}) d
JOIN ({ORACLE["station_rolling"]}) r ON d.hire_date = r.hire_date AND d.station_id IS NOT DISTINCT FROM r.station_id""",
)


def _presence(table: str, columns: str) -> list[str]:
    return [
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, TRUE AS present, count({c}) AS filled FROM {table}"
        for c in columns.split()
    ]


oracle(
    "schema_presence",
    "\nUNION ALL ".join(
        _presence(
            "cycle_hire",
            "rental_id bike_id duration start_date start_station_id start_station_name end_date "
            "end_station_id end_station_name",
        )
        + _presence("cycle_stations", "id name latitude longitude docks_count terminal_name")
    ),
)
_FACT_TYPES = """ride_sk string, rental_id bigint, bike_id bigint, hire_date date, start_datetime timestamp,
end_datetime timestamp, start_hour bigint, day_of_week bigint, is_weekend boolean, time_period string,
peak_hour_flag bigint, duration_seconds bigint, duration_minutes double, duration_band string,
start_station_id bigint, start_station_name string, start_zone string, start_nb_docks bigint,
start_capacity_tier string, start_lat double, start_lon double, end_station_id bigint,
end_station_name string, end_zone string, end_nb_docks bigint, end_capacity_tier string, end_lat double,
end_lon double, is_round_trip boolean, start_station_imbalance_score double,
start_station_is_imbalanced boolean, start_station_imbalance_direction string,
start_station_net_flow bigint, start_station_utilisation_rate double, start_station_rolling_7d_avg double"""
oracle(
    "fact_schema",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, CAST({i} AS INTEGER) AS ordinal_position, "
        f"count({c}) AS filled FROM fact"
        for i, (c, t) in enumerate((pair.split() for pair in _FACT_TYPES.split(",")), 1)
    ),
)
oracle(
    "quality_report",
    f"""SELECT checkpoint, status, count(*) AS checks FROM ({ORACLE["quality_post_ingest"]}) GROUP BY 1, 2""",
)


def _mentions(sql: str) -> set[str]:
    words = set(re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", sql))
    return words & set(CTES)


def compose(sql: str) -> str:
    """Put every common table expression that ``sql`` needs in front of it."""
    needed: set[str] = set()
    todo = _mentions(sql)
    while todo:
        name = todo.pop()
        needed.add(name)
        todo |= _mentions(CTES[name]) - needed
    # Names that the text uses as columns or words are harmless: only FROM and JOIN are followed.
    ordered = _in_order(needed)
    if not ordered:
        return sql
    ctes = ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in ordered)
    return f"WITH {ctes}\n{sql}"


def _in_order(names: set[str]) -> list[str]:
    done: list[str] = []

    def visit(name: str) -> None:
        if name in done:
            return
        for needed in sorted(_mentions(CTES[name])):
            visit(needed)
        done.append(name)

    for name in sorted(names):
        visit(name)
    return done


def all_oracles() -> dict[str, str]:
    return {name: compose(sql) for name, sql in ORACLE.items()}
