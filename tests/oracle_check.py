"""Run registered queries in Spark and their SQL in DuckDB and compare.

    python tests/oracle_check.py SF_DIR [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _canonical(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return str(value)
    if isinstance(value, (list, tuple)):
        return str([_canonical(v) for v in value])
    return str(value)


def canonical_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_canonical(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, con, name, fn, sql, sf_dir):
    """Return (rows, problem); problem is None when both sides agree."""
    df = fn(spark, sf_dir)
    got = canonical_rows(df.columns, df.collect())
    if sql is None:
        return len(got), None if got else "no rows"
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return len(got), f"columns {sorted(df.columns)} against {sorted(columns)}"
    want = canonical_rows(columns, cursor.fetchall())
    if got == want:
        return len(got), None if got else "no rows"
    names = sorted(columns)
    only_got = [r for r in got if r not in set(want)][:2]
    only_want = [r for r in want if r not in set(got)][:2]
    return len(got), f"{len(got)} rows against {len(want)}\n   {names}\n   spark {only_got}\n   sql   {only_want}"


def main():
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from tallyhouse.queries import ORACLE, QUERIES
    from tallyhouse.session import build_session
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(master="local[8]", extra={
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "10g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, fn in QUERIES.items():
        if names and name not in names and fn.__module__ not in names:
            continue
        start = time.time()
        try:
            rows, problem = compare(spark, con, name, fn, ORACLE.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on
            rows, problem = -1, f"{type(error).__name__}: {str(error)[:900]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} rows={rows} "
              f"{time.time() - start:.1f}s {problem or ''}", flush=True)
    print("problems:", bad)


if __name__ == "__main__":
    main()
