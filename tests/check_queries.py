"""Run registered queries and their SQL side by side: ``python -m tests.check_queries [folder] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    return sorted(columns), sorted((tuple(row[at] for at in order) for row in rows), key=repr)


def compare(spark, folder, name, query, sql):
    frame = query(spark, folder)
    got = canonical(frame.columns, [tuple(row) for row in frame.collect()])
    db = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    result = db.execute(sql)
    expected = canonical([column[0] for column in result.description], result.fetchall())
    return got, expected


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = []
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            got, expected = compare(spark, folder, name, queries[name], oracle[name])
        except Exception as problem:  # noqa: BLE001
            print(f"{name}: ERROR {str(problem)[:700]}", flush=True)
            failed.append(name)
            continue
        if got == expected:
            print(f"{name}: ok, {len(got[1])} rows, {time.time() - start:.1f} s", flush=True)
            continue
        failed.append(name)
        print(f"{name}: DIFFERS {got[0]} {expected[0]} {len(got[1])} {len(expected[1])}")
        for ours, theirs in [(a, b) for a, b in zip(got[1], expected[1]) if a != b][:2]:
            print("   got", str(ours)[:500], "\n   sql", str(theirs)[:500], flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
