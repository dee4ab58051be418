"""Hand-made raw frames."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from dockflow.sources import schemas


def ride(rental_id, start, seconds, start_id, end_id, name=None, end_name=None, bike=1):
    begin = datetime.fromisoformat(start) if start else None
    end = begin + timedelta(seconds=seconds) if begin and seconds is not None else None
    label = lambda i, given: given or (None if i is None else f"S{i}")
    return {
        "rental_id": rental_id,
        "duration": seconds,
        "bike_id": bike,
        "end_date": end,
        "end_station_id": end_id,
        "end_station_name": label(end_id, end_name),
        "start_date": begin,
        "start_station_id": start_id,
        "start_station_name": label(start_id, name),
    }


def station(station_id, lat=51.51, lon=-0.1, docks=20, name=None):
    return {
        "id": station_id,
        "installed": True,
        "locked": False,
        "install_date": datetime(2010, 7, 1).date(),
        "name": name or f"S{station_id}",
        "terminal_name": f"{station_id:05d}",
        "latitude": lat,
        "longitude": lon,
        "docks_count": docks,
        "temporary": False,
    }


def _frame(spark, rows, schema):
    loose = type(schema)([type(f)(f.name, f.dataType, True) for f in schema])
    return spark.createDataFrame([tuple(r[n] for n in schema.fieldNames()) for r in rows], loose)


def rides_frame(spark, rows):
    return _frame(spark, rows, schemas.RIDES)


def stations_frame(spark, rows):
    return _frame(spark, rows, schemas.STATIONS)


def column(frame, name, order):
    return [r[name] for r in frame.orderBy(order).select(name).collect()]


def rows(frame):
    """Rows as sorted tuples of plain values, doubles rounded."""
    out = []
    for r in frame.collect():
        out.append(tuple(round(v, 6) if isinstance(v, float) else v for v in r))
    return sorted(out, key=lambda t: tuple((v is None, str(v)) for v in t))


def values(spark, name, kind, items):
    return spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, {name} {kind}")


__all__ = ["F", "ride", "station", "rides_frame", "stations_frame", "column", "rows", "values"]
