"""Runs registered queries against the oracle: ``python -m checks.compare [sf_dir] [key ...]``."""

from __future__ import annotations

import sys
import time

import duckdb

from checks import catalog
from riskwatch.session import build_session

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def normal(row: dict) -> tuple:
    """Columns by name; doubles and integers keep their types."""
    return tuple((k, type(v).__name__, str(v)) for k, v in sorted(row.items()))


def differences(spark, connection, key: str, sf_dir: str) -> list[str]:
    """Empty when columns, rows and values agree."""
    mine = [r.asDict() for r in catalog.QUERIES[key](spark, sf_dir).collect()]
    cursor = connection.execute(catalog.ORACLES[key])
    names = [d[0] for d in cursor.description]
    theirs = [dict(zip(names, r)) for r in cursor.fetchall()]
    a, b = sorted(map(normal, mine)), sorted(map(normal, theirs))
    if a == b:
        return [] if a else ["no rows"]
    only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    shown = [f"{len(a)} rows against {len(b)}; {len(only_a)} and {len(only_b)} without a match"]
    if only_a and only_b:
        pairs = [(p, q) for p, q in zip(only_a[0], only_b[0]) if p != q]
        shown += [f"  {p}\n  {q}" for p, q in pairs[:4]]
        if len(only_a[0]) != len(only_b[0]):
            shown.append(f"  {[p[0] for p in only_a[0]]}\n  {[p[0] for p in only_b[0]]}")
    return shown


def main(arguments: list[str]) -> int:
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    keys = arguments[1:] or list(catalog.QUERIES)
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = oracle(sf_dir), 0
    for key in keys:
        start = time.time()
        try:
            found = differences(spark, connection, key, sf_dir)
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:800]}"]
        failed += bool(found)
        print(f"{key:8} {'differs' if found else 'same':8} {time.time() - start:6.2f}s", flush=True)
        for line in found:
            print("   ", line[:1500], flush=True)
    print(f"{len(keys) - failed} of {len(keys)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
