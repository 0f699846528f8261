"""Run queries in Spark and their SQL in DuckDB and compare the results.

usage: python -m checks.compare [--sf 0.01] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import hashlib
import math
import time

import duckdb

from checks import ORACLES, QUERIES, load_all
from checks.fixtures import _BASE
from checks.registry import runnable
from postsieve.session import build_session


def _cell(value) -> str:
    if value is None:
        return "~"
    if isinstance(value, bool):
        return "t" if value else "f"
    if isinstance(value, float):
        if math.isnan(value):
            return "~"
        return f"{value:.9g}"
    return str(value)


def result_hash(columns: list[str], rows: list) -> str:
    """Order-insensitive hash of a result."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_cell(row[i]) for i in order) for row in rows)
    return hashlib.md5("\x1e".join(lines).encode("utf-8", "surrogatepass")).hexdigest()


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--show", action="store_true")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    load_all()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark = build_session(**{
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g", "spark.ui.enabled": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in QUERIES if not args.names or any(n.startswith(p) for p in args.names)]
    bad = []
    for name in names:
        started = time.time()
        try:
            df = runnable(QUERIES[name])(spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
        except Exception as error:  # noqa: BLE001 - reported
            print(f"{name:32} ERROR {str(error)[:600]}", flush=True)
            bad.append(name)
            continue
        spark_s = time.time() - started
        if name not in ORACLES:
            print(f"{name:32} rows-only {len(rows):8} {spark_s:6.1f}s", flush=True)
            continue
        connection = duckdb.connect()
        for table in _BASE:
            connection.execute(
                f"create view {table} as select * from '{sf_dir}/{table}.parquet'"
            )
        started = time.time()
        try:
            cursor = connection.execute(ORACLES[name])
            columns = [d[0] for d in cursor.description]
            expected = cursor.fetchall()
        except Exception as error:  # noqa: BLE001 - reported
            print(f"{name:32} SQL ERROR {str(error)[:600]}", flush=True)
            bad.append(name)
            continue
        duck_s = time.time() - started
        same = (
            sorted(columns) == sorted(df.columns)
            and len(rows) == len(expected)
            and result_hash(df.columns, rows) == result_hash(columns, expected)
        )
        verdict = "ok" if same else "DIFF"
        print(f"{name:32} {verdict:5} {len(rows):8} {spark_s:6.1f}s {duck_s:6.1f}s", flush=True)
        if not same:
            bad.append(name)
            order = sorted(df.columns)
            left = sorted(str([_cell(r[df.columns.index(c)]) for c in order]) for r in rows)
            if sorted(columns) != order:
                print("   columns", sorted(columns), order)
                continue
            right = sorted(str([_cell(r[columns.index(c)]) for c in order]) for r in expected)
            only_left, only_right = sorted(set(left) - set(right)), sorted(set(right) - set(left))
            print("   rows", len(rows), len(expected), "differing", len(only_left), len(only_right))
            for line in only_left[:2]:
                print("   spark ", line[:700])
            for line in only_right[:2]:
                print("   duckdb", line[:700])
    print(f"{len(names)} queries, {len(bad)} bad: {bad}")


if __name__ == "__main__":
    main()
