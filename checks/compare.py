"""Run registered queries and their SQL side by side: ``python -m checks.compare SF_DIR [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.queries import registered
from checks.sql import statements


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(rows, columns) -> list:
    """Rows with columns by name and a total order, for values of both engines."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(spark: SparkSession, con, sf_dir: str, name: str) -> str | None:
    df = registered()[name](spark, sf_dir)
    found = canonical([tuple(r) for r in df.collect()], df.columns)
    result = con.execute(statements()[name])
    names = [c[0] for c in result.description]
    wanted = canonical(result.fetchall(), names)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(found) != len(wanted):
        return f"rows {len(found)} != {len(wanted)}"
    if repr(found) == repr(wanted):
        return None
    first = next((f, w) for f, w in zip(found, wanted) if repr(f) != repr(w))
    return f"{sum(repr(f) != repr(w) for f, w in zip(found, wanted))} of {len(found)} rows differ, first {first}"


def main(sf_dir: str, *names: str) -> int:
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in names or registered():
        start = time.perf_counter()
        if name in statements():
            problem = differences(spark, con, sf_dir, name)
        else:
            problem = None if registered()[name](spark, sf_dir).count() else "no rows"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.perf_counter() - start:.1f}s {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]) > 0)
