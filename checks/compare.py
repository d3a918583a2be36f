"""Run registered queries against their SQL: ``python -m checks.compare [folder] [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(r[i]).__name__, r[i]) for i in order) for r in rows)


def compare(spark: SparkSession, con, folder: str, name: str) -> str:
    """``ok`` or what differs."""
    df = QUERIES[name](spark, folder)
    mine = rows_of(df.columns, df.collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "NestedLoopJoin" in plan or "CartesianProduct" in plan:
        return "the plan pairs all rows"
    if name not in ORACLES:
        return f"ok, rows only ({sum(mine.values())})"
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    theirs = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if mine != theirs:
        return f"rows differ: only here {list((mine - theirs).items())[:2]}, only there {list((theirs - mine).items())[:2]}"
    return f"ok ({sum(mine.values())})"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(folder), 0
    for name in names:
        began = time.time()
        try:
            outcome = compare(spark, con, folder, name)
        except Exception as e:  # report every query, whatever happens to one
            outcome = f"error: {str(e)[:500]}"
        bad += not outcome.startswith("ok")
        print(f"{name:55s} {time.time() - began:6.2f}s {outcome}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
