"""Compare registered queries with their SQL oracles: ``python -m tests.oracle [sf_dir] [query…]``."""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, Decimal):
        return f"decimal {v}"
    return f"{type(v).__name__} {v}" if isinstance(v, bool) else str(v)


def _sorted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


KINDS = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz", "HUGEINT": "HUGEINT",
}


def differences(df, con, sql) -> list[str]:
    """What differs between a Spark result and an oracle's, empty if nothing."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in found.description}
    expected = found.fetchall()
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for c, t in df.dtypes:
        if kinds[c] != t:
            problems.append(f"type of {c}: {t} != {kinds[c]}")
    got = [tuple(r) for r in df.collect()]
    a, b = _sorted(got, df.columns), _sorted(expected, names)
    if len(a) != len(b):
        problems.append(f"{len(a)} rows != {len(b)}")
    elif a != b:
        pairs = [(x, y) for x, y in zip(a, b) if x != y]
        problems.append(f"{len(pairs)} of {len(a)} rows differ, first {pairs[0]}")
    return problems


def main() -> int:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in chosen:
        start = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            sql = oracle_sql().get(name)
            problems = differences(df, con, sql) if sql else []
            state = "FAIL " + "; ".join(problems) if problems else ("ok" if sql else f"{df.count()} rows, no oracle")
        except Exception as e:
            state = "FAIL " + str(e)[:1500]
        failed += state.startswith("FAIL")
        print(f"{name:28s} {time.time() - start:6.2f}s {state[:1800]}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main())
