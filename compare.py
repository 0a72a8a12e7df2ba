"""Run queries in Spark and in DuckDB on one folder of test tables and compare the rows.

    python compare.py [folder] [query ...]

COMPARE_CONF may hold further Spark settings, as ``name=value name=value``.
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

from sluice.oracle import ORACLES
from sluice.registry import QUERIES
from sluice.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def differences(spark, con, name: str, folder: str) -> list[str]:
    """What differs between both results: columns, types or rows."""
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    mine = df.select(*columns).collect()
    result = con.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]}) q")
    if sorted(con.sql(ORACLES[name]).columns) != columns:
        return [f"columns {columns} / {sorted(con.sql(ORACLES[name]).columns)}"]
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}
    found = [
        f"type of {c}: {t} / {d}"
        for (c, t), d in zip(df.select(*columns).dtypes, result.types, strict=True)
        if kinds[t] != str(d)
    ]
    left, right = Counter(map(tuple, mine)), Counter(result.fetchall())
    if left != right:
        found.append(f"{len(mine)} / {sum(right.values())} rows")
        found += [f"  only Spark: {r}" for r in list((left - right))[:3]]
        found += [f"  only SQL:   {r}" for r in list((right - left))[:3]]
    return found


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        **dict(setting.split("=", 1) for setting in os.environ.get("COMPARE_CONF", "").split()),
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            found = differences(spark, con, name, folder)
        except Exception as problem:  # report and go on with the next query
            found = [f"{type(problem).__name__}: {str(problem)[:600]}"]
        bad += bool(found)
        print(f"{'DIFF' if found else 'ok  '} {name} {time.time() - start:.1f}s", flush=True)
        for line in found:
            print("    ", line, flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
