"""Compare registered queries with their reference SQL on given tables."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, con, name, query, sql, sf_dir) -> str:
    """Empty when equal, else a short account of the difference."""
    df = query(spark, sf_dir)
    ours = bag(df.columns, df.collect())
    if sql is None:
        return "" if ours else "no rows"
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} / {sorted(rel.columns)}"
    theirs = bag(rel.columns, rel.fetchall())
    if ours == theirs:
        return ""
    only_ours, only_theirs = ours - theirs, theirs - ours
    sample = "; ".join(str(next(iter(x), None))[:350] for x in (only_ours, only_theirs))
    return f"rows {sum(ours.values())} / {sum(theirs.values())}, differing {len(only_ours)} / {len(only_theirs)}: {sample}"


def main() -> None:
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, root)
    import __spark_entry__ as contract
    from newsmill.session import build_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(sf_dir), contract.oracle_sql()
    bad = 0
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            result = compare(spark, con, name, query, sqls.get(name), sf_dir)
        except Exception as err:  # noqa: BLE001
            result = f"{type(err).__name__}: {str(err)[:300]}"
        bad += bool(result)
        print(f"{name:20s} {time.time() - start:6.2f}s {'ok' if not result else result}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
