"""Compare queries with their SQL equivalents: ``check.py [--sf DIR] [name ...]``."""

from __future__ import annotations

import argparse
import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from queries import registry  # noqa: E402

TABLES = ("events", "orders", "lineitem")


def session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="check-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def canonical(rows, columns):
    """Rows as sorted tuples, in column name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else float(f"{v:.10g}") + 0.0
        return v

    out = [tuple(cell(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, sf_dir, name):
    start = time.time()
    df = registry.QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if name not in registry.ORACLES:
        return f"rows-only n={len(rows)}", took, bool(rows)
    cursor = con.execute(registry.ORACLES[name])
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(set(names) ^ set(df.columns))}", took, False
    ours, theirs = canonical(rows, df.columns), canonical(expected, names)
    if len(ours) != len(theirs):
        return f"row counts differ: {len(ours)} vs {len(theirs)}", took, False
    off = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if off:
        return f"{len(off)} of {len(ours)} rows differ, e.g.\n   {off[0][0]}\n   {off[0][1]}", took, False
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    unlike = []
    plain = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    for c, t in df.dtypes:
        if plain.get(t) != kinds[c]:
            unlike.append(f"{c}: {t} vs {kinds[c]}")
    return f"ok n={len(ours)}" + (f" TYPES {unlike}" if unlike else ""), took, True


def main():
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.01")
    args.add_argument("names", nargs="*")
    opts = args.parse_args()
    spark = session()
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{opts.sf}/{t}.parquet'")
    failed = []
    for name in opts.names or list(registry.QUERIES):
        try:
            text, took, good = compare(spark, con, opts.sf, name)
        except Exception as err:  # a broken query must not hide the others
            text, took, good = f"ERROR {type(err).__name__}: {str(err)[:600]}", 0.0, False
        print(f"{'PASS' if good else 'FAIL'} {name} {took:.1f}s {text}", flush=True)
        if not good:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main()
