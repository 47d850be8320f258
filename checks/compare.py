"""Compare every query with its SQL: ``python -m checks.compare [folder] [query ...]``."""

from __future__ import annotations

import glob
import os
import sys
import tempfile
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import statements
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def session(name: str = "monthgrain-checks", cpus: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", os.environ.get("CHECKS_DIR") or tempfile.mkdtemp())
        .getOrCreate()
    )


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


def difference(spark: SparkSession, con, folder: str, name: str) -> str | None:
    """What differs between the two results; ``None`` if nothing does."""
    df = QUERIES[name](spark, folder)
    ours = _rows(df.columns, df.collect())
    result = con.execute(statements()[name])
    columns = [c[0] for c in result.description]
    theirs = _rows(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {set(df.columns) ^ set(columns)}"
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    sql_kinds = {c[0]: str(c[1]).lower() for c in result.description}
    same = {"string": "varchar", "int": "integer"}
    for c, kind in kinds.items():
        if same.get(kind, kind) != sql_kinds[c]:
            return f"type of {c}: {kind} and {sql_kinds[c]}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows, SQL has {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            cols = sorted(df.columns)
            return f"values {[(c, x, y) for c, x, y in zip(cols, a, b) if x != y][:5]} of {a[:3]}"
    return None if ours else "no rows"


def main(folder: str = FOLDER, *names: str) -> int:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    failed = 0
    for name in names or statements():
        start = time.time()
        what = difference(spark, con, folder, name)
        failed += what is not None
        print(f"{'ok  ' if what is None else 'FAIL'} {name} {time.time() - start:.1f}s {what or ''}")
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
