"""Run every registered query against its SQL in DuckDB: python tests/oracle_check.py [sf] [name…]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as contract  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
    "decimal(18,2)": "DECIMAL(18,2)",
}


def normalised(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(str(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(shaped)


def differences(spark: SparkSession, con, name: str, sf_dir: str) -> str | None:
    """None if both engines agree on columns and rows, otherwise what differs."""
    df = contract.queries()[name](spark, sf_dir)
    got = normalised(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(contract.oracle_sql()[name])
    want = normalised([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    types = dict(df.dtypes)
    for column, duck_type in [(d[0], str(d[1])) for d in con.execute(f"DESCRIBE {contract.oracle_sql()[name]}").fetchall()]:
        if SAME_TYPE[types[column]] != duck_type:
            return f"type of {column}: {types[column]} != {duck_type}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    if got[1] != want[1]:
        unlike = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
        return f"{len(unlike)} rows differ, first {unlike[0]}"
    return None if want[1] else "no rows to compare"


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in sys.argv[2:] or contract.oracle_sql():
        start = time.time()
        try:
            found = differences(spark, con, name, sf_dir)
        except Exception as e:  # report and go on
            found = f"{type(e).__name__}: {str(e)[:800]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print(f"{bad} of {len(sys.argv[2:] or contract.oracle_sql())} differ")


if __name__ == "__main__":
    main()
