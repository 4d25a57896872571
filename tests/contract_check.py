"""Run queries beside their SQL on one scale factor: ``python tests/contract_check.py sf0.01 [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value + 0.0:.9g}"
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf_dir) -> str:
    """An empty string where both sides agree, else the first difference."""
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return "" if got else "no rows"
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    wanted = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    types = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    theirs = dict(zip(columns, (str(d[1]) for d in cursor.description)))
    differ = {c: (t, theirs[c]) for c, t in df.dtypes if types.get(t) != theirs[c]}
    if differ:
        return f"types {differ}"
    a, b = rows_of(df.columns, got), rows_of(columns, wanted)
    if a == b:
        return ""
    only_spark, only_sql = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
    return f"{len(a)} rows against {len(b)}; only Spark: {str(only_spark)[:400]}; only SQL: {str(only_sql)[:400]}"


def main() -> int:
    import __spark_entry__ as contract

    sf_dir = f"/root/testdata/{sys.argv[1]}" if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = session(), connection(sf_dir)
    oracle, failed = contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.perf_counter()
        try:
            problem = compare(spark, con, name, query, oracle.get(name), sf_dir)
        except Exception as error:  # keep going, report all
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        kind = "sql" if name in oracle else "rows"
        print(f"{'ok  ' if not problem else 'FAIL'} {kind:4} {time.perf_counter() - started:6.1f}s {name} {problem}", flush=True)
        failed += bool(problem)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
