"""Run registered queries beside their SQL in DuckDB and compare names, types and values.

``python -m tests.oracle [folder] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

import __spark_entry__ as entry

SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def connect(folder: str):
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark, con, folder: str, name: str) -> list[str]:
    """What differs between a query and its SQL; empty if nothing does."""
    df = entry.queries()[name](spark, folder)
    sql = entry.oracle_sql()[name]
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    expected = {row[0]: row[1] for row in described}
    found = {n: SAME_TYPE.get(t, t) for n, t in df.dtypes}
    problems = []
    if expected != found:
        problems.append(f"schema {sorted(expected.items() ^ found.items())}")
    if set(expected) == set(found):
        ours = _rows(df.columns, df.collect())
        theirs = _rows(list(expected), con.execute(sql).fetchall())
        if len(ours) != len(theirs):
            problems.append(f"{len(ours)} rows, expected {len(theirs)}")
        wrong = [(a, b) for a, b in zip(ours, theirs, strict=False) if a != b]
        if wrong:
            problems.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return problems


def main(folder: str, names: list[str]) -> int:
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in names or entry.queries():
        start = time.time()
        try:
            if name in entry.oracle_sql():
                problems = differences(spark, con, folder, name)
            else:
                problems = [] if entry.queries()[name](spark, folder).collect() else ["no rows"]
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok'} {name} {time.time() - start:.1f}s {problems or ''}")
        sys.stdout.flush()
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(bool(main(args[0] if args else "/root/testdata/sf0.01", args[1:])))
