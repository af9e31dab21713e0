"""Compare queries with their SQL twins: ``python -m checks.run [sf_dir] [name …]``."""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

import checks.streams  # noqa: F401  (registers its queries)
from checks.catalog import QUERIES, TWINS


def plain(value):
    if isinstance(value, float):
        return round(value, 9)
    return value


def compare(spark: SparkSession, sf_dir: str, name: str) -> str:
    start = time.time()
    frame = QUERIES[name](spark, sf_dir)
    names = sorted(frame.columns)
    got = Counter(tuple(plain(row[c]) for c in names) for row in frame.collect())
    spark_seconds = time.time() - start
    if name not in TWINS:
        return f"rows   {name}: {sum(got.values())} rows, {spark_seconds:.1f}s"
    start = time.time()
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    result = db.execute(TWINS[name])
    columns = [d[0] for d in result.description]
    if sorted(columns) != names:
        return f"FAIL   {name}: columns {names} vs {sorted(columns)}"
    order = [columns.index(c) for c in names]
    want = Counter(tuple(plain(row[i]) for i in order) for row in result.fetchall())
    sql_seconds = time.time() - start
    if got == want:
        return f"ok     {name}: {sum(got.values())} rows, {spark_seconds:.1f}s, sql {sql_seconds:.1f}s"
    missing, extra = list((want - got).items())[:2], list((got - want).items())[:2]
    return (f"FAIL   {name}: {sum(got.values())} vs {sum(want.values())} rows {names}\n"
            f"   only sql   {str(missing)[:700]}\n   only spark {str(extra)[:700]}")


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
               .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    for query_name in sys.argv[2:] or list(QUERIES):
        try:
            print(compare(session, folder, query_name), flush=True)
        except Exception as error:
            print(f"ERROR  {query_name}: {type(error).__name__} {str(error)[:1500]}", flush=True)
