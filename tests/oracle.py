"""Compares registered queries with their SQL in DuckDB. ``python tests/oracle.py FOLDER [name…]`` prints a report."""

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5) + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(df, db, sql: str) -> str:
    """An empty string if both give the same rows, else what differs."""
    found = db.execute(sql)
    columns = [d[0] for d in found.description]
    expected = _sorted(found.fetchall(), columns)
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    kinds = {c: str(t) for c, t in zip(columns, [d[1] for d in found.description])}
    same = {"double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE",
            "boolean": "BOOLEAN"}
    odd = {c: (t, kinds[c]) for c, t in df.dtypes if same.get(t, kinds[c]) != kinds[c]}
    table = df.toArrow().to_pydict()
    actual = _sorted(zip(*table.values()), list(table))
    if len(actual) != len(expected):
        return f"rows {len(actual)} vs {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        return f"{len(wrong)} of {len(expected)} rows differ, first {wrong[0]}"
    return f"types {odd}" if odd else ""


def main(folder: str, names: list[str]) -> None:
    from __spark_entry__ import oracle_sql, queries
    from tidepanel.session import local_session

    spark = local_session(8)
    db = connect(folder)
    runs, sql = queries(), oracle_sql()
    bad = 0
    for name in names or runs:
        start = time.time()
        try:
            df = runs[name](spark, folder)
            if name in sql:
                problem = compare(df, db, sql[name])
            else:
                n = df.count()
                problem = "" if n else "no rows"
                name = f"{name} [{n} rows]"
        except Exception as e:  # a report goes on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - start:6.1f}s {name} {problem}", flush=True)
    print(f"{bad} failures")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
