"""Run registered queries and their SQL side by side: python tests/parity_check.py FOLDER [NAME ...]"""

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from dockflow.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
ARROW_NAMES = {"int64": "bigint", "int32": "int", "double": "double", "string": "string", "bool": "boolean",
               "date32[day]": "date", "large_string": "string"}


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 8) + 0.0
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    return value


def rows_of(arrow) -> list[tuple]:
    names = sorted(arrow.column_names)
    rows = zip(*[[plain(v) for v in arrow.column(n).to_pylist()] for n in names])
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def types_of(arrow) -> dict[str, str]:
    out = {}
    for field in arrow.schema:
        text = str(field.type)
        out[field.name] = "timestamp" if text.startswith("timestamp") else ARROW_NAMES.get(text, text)
    return out


def difference(spark, con, name: str, folder: str) -> str | None:
    """None when rows and types agree, else the first difference."""
    ours = entry.queries()[name](spark, folder).toArrow()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None
    theirs = con.sql(sql).to_arrow_table()
    if types_of(ours) != types_of(theirs):
        a, b = types_of(ours), types_of(theirs)
        return f"types differ: {[(k, a.get(k), b.get(k)) for k in a | b if a.get(k) != b.get(k)]}"
    left, right = rows_of(ours), rows_of(theirs)
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    for one, two in zip(left, right):
        if one != two:
            return f"rows differ:\n  {sorted(ours.column_names)}\n  {one}\n  {two}"
    return None


def main() -> int:
    folder, names = sys.argv[1], sys.argv[2:]
    spark = build_session(master="local[8]", extra={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    con = connect(folder)
    bad = 0
    for name in names or entry.queries():
        started = time.time()
        try:
            problem = difference(spark, con, name, folder)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        known = "sql" if name in entry.oracle_sql() else "rows only"
        print(f"{'ok ' if problem is None else 'BAD'} {name} ({known}) {time.time() - started:.2f}s {problem or ''}", flush=True)
    print(f"{bad} of {len(names or entry.queries())} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
