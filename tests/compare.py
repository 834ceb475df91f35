"""Run registered queries in Spark and their oracles in DuckDB, and compare whole results."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def as_counter(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(r[i] for i in order) for r in rows)


def differences(df, con, sql) -> str | None:
    """None when the results are equal, else a short account."""
    names, got = as_counter(df.columns, [tuple(r) for r in df.collect()])
    relation = con.sql(sql)
    expected_names, expected = as_counter(relation.columns, relation.fetchall())
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if got == expected:
        return None
    more, less = got - expected, expected - got
    return f"rows {sum(got.values())} vs {sum(expected.values())}; only Spark {list(more)[:2]}; only DuckDB {list(less)[:2]}"


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name, query in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            result = differences(query(spark, sf), con, entry.oracle_sql()[name])
        except Exception as error:  # report and go on
            result = f"{type(error).__name__}: {str(error)[:600]}"
        bad += result is not None
        print(f"CHECK {name} {time.time() - start:.1f}s {result or 'ok'}"[:900], flush=True)
    print(f"CHECK {bad} differ")


if __name__ == "__main__":
    main()
