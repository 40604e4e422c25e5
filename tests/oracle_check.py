"""Runs queries and their SQL side by side: ``python tests/oracle_check.py [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(value):
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return f"{value:.9g}"
    return str(value)


def compare(spark_df, con, sql: str) -> str:
    """Empty when equal, else what differs."""
    names = sorted(spark_df.columns)
    mine = sorted(tuple(canonical(row[name]) for name in names) for row in spark_df.collect())
    result = con.execute(sql)
    columns = [item[0] for item in result.description]
    if sorted(columns) != names:
        return f"columns {names} <> {sorted(columns)}"
    order = [columns.index(name) for name in names]
    theirs = sorted(tuple(canonical(row[i]) for i in order) for row in result.fetchall())
    if mine == theirs:
        return ""
    extra = [row for row in mine if row not in set(theirs)][:3]
    lacking = [row for row in theirs if row not in set(mine)][:3]
    return f"rows {len(mine)} <> {len(theirs)}; {names}; only here {extra}; only there {lacking}"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tickloom.session import build_session

    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = database(SF)
    wanted = sys.argv[1:] or list(entry.queries())
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            df = entry.queries()[name](spark, SF)
            sql = entry.oracle_sql().get(name)
            problem = compare(df, con, sql) if sql else f"no oracle, rows {len(df.collect())}"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem) and not problem.startswith("no oracle")
        print(f"{name:28s} {time.time()-start:6.2f}s {problem or 'ok'}", flush=True)
    print("mismatches:", bad)
    sys.exit(bool(bad))
