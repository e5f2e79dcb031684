"""Run registered queries against their SQL in DuckDB and report differences.

Usage: python -m checks.compare [--data DIR] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracles import ORACLES
from checks.registry import QUERIES


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tillscope-checks")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns by name, in a fixed order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), canonical(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return sorted(names), canonical(names, result.fetchall())


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, folder: str) -> tuple[str, int]:
    """('' if equal else a description, number of rows)."""
    columns, rows = spark_rows(QUERIES[name](spark, folder))
    if name not in ORACLES:
        return "", len(rows)
    want_columns, want = duck_rows(con, ORACLES[name])
    if columns != want_columns:
        return f"columns {columns} != {want_columns}", len(rows)
    if len(rows) != len(want):
        return f"{len(rows)} rows != {len(want)}", len(rows)
    unequal = [(a, b) for a, b in zip(rows, want) if a != b]
    if unequal:
        return f"{len(unequal)} of {len(rows)} rows differ, first:\n   {unequal[0][0]}\n   {unequal[0][1]}", len(rows)
    return "", len(rows)


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--data", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, con = session(), database(args.data)
    chosen = [n for n in QUERIES if not args.names or any(n.startswith(p) for p in args.names)]
    failed = 0
    for name in chosen:
        began = time.time()
        try:
            problem, count = difference(spark, con, name, args.data)
        except Exception as error:  # report and go on with the next query
            problem, count = f"{type(error).__name__}: {str(error)[:600]}", -1
        failed += bool(problem)
        kind = "sql" if name in ORACLES else "rows only"
        print(f"{'FAIL' if problem else 'ok':4} {name} rows={count} {time.time() - began:.1f}s {kind} {problem}", flush=True)
    print(f"{len(chosen) - failed} of {len(chosen)} equal")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
