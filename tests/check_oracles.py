"""Run every catalog query beside its SQL counterpart and report differences.

    python tests/check_oracles.py [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, list):
        return tuple(norm(x) for x in v)
    return v


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


SQL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


def compare(df, con, text: str) -> str | None:
    """None when both sides agree, else what differs."""
    ours = table_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(text)
    types = {c[0]: str(c[1]) for c in res.description}
    for name, kind in df.dtypes:
        if name in types and SQL_TYPES.get(kind, kind) != types[name]:
            print(f"  type of {name}: {kind} != {types[name]}")
    theirs = table_of([c[0] for c in res.description], res.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if ours[1] != theirs[1]:
        a, b = set(map(repr, ours[1])), set(map(repr, theirs[1]))
        return (
            f"{len(ours[1])} rows != {len(theirs[1])}; ours only {len(a - b)}: "
            f"{sorted(a - b)[:3]}; theirs only {len(b - a)}: {sorted(b - a)[:3]}"
        )
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(contract.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con, oracle = connect(folder), contract.oracle_sql()
    for name in names:
        start = time.time()
        try:
            df = contract.queries()[name](spark, folder)
            if name in oracle:
                verdict = compare(df, con, oracle[name]) or f"ok {df.count()} rows"
            else:
                verdict = f"rows only: {[tuple(r) for r in df.collect()][:3]}"
        except Exception as e:  # noqa: BLE001
            verdict = f"FAILED {type(e).__name__}: {str(e)[:600]}"
        print(f"{name}: {verdict} [{time.time() - start:.1f}s]", flush=True)


if __name__ == "__main__":
    main()
