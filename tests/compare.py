"""Runs queries next to their oracles: names, row counts and values must agree."""

from __future__ import annotations

import argparse
import datetime
import decimal
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from trialspark.plans import registry  # noqa: E402
from trialspark.plans.tables import BASE  # noqa: E402


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    typed = [tuple((type(plain(r[i])).__name__, plain(r[i])) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(typed, key=repr)


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET threads = 8")
    for name in BASE:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def difference(df, con, sql: str) -> str | None:
    """None when both sides agree, else a short account of the difference."""
    cursor = con.execute(sql)
    spark_columns, spark_rows = table(df.columns, df.collect())
    duck_columns, duck_rows = table([c[0] for c in cursor.description], cursor.fetchall())
    if spark_columns != duck_columns:
        return f"columns {spark_columns} != {duck_columns}"
    ours = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    theirs = {c[0]: str(c[1]) for c in cursor.description}
    if ours != theirs:
        return f"types {[(c, ours[c], theirs[c]) for c in ours if ours[c] != theirs[c]]}"
    if len(spark_rows) != len(duck_rows):
        return f"rows {len(spark_rows)} != {len(duck_rows)}"
    for ours, theirs in zip(spark_rows, duck_rows):
        if ours != theirs:
            return f"first difference\n  spark {ours}\n  duck  {theirs}"
    return None if spark_rows else "no rows on either side"


def main():
    from trialspark.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("prefix", nargs="*")
    parser.add_argument("--dir", default="/root/testdata/sf0.01")
    args = parser.parse_args()
    spark = build_session(
        "compare", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = registry.load()
    con = connect(args.dir)
    bad = 0
    for name, build in queries.items():
        if args.prefix and not any(name.startswith(p) or p in build.__module__ for p in args.prefix):
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = difference(build(spark, args.dir), con, oracles[name])
            else:
                problem = None if build(spark, args.dir).count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
            con = connect(args.dir)
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
