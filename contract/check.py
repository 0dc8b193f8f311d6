"""Compare queries with their SQL twins: columns, types and every value.

    python -m contract.check --dir /root/testdata/sf0.01 [--only name ...]
"""

from __future__ import annotations

import argparse
import datetime
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from contract.oracle import ORACLE_SQL
from contract.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

SPARK_TO_DUCKDB = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def duckdb_over(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _key(row: tuple) -> tuple:
    return tuple((v is not None, str(v)) for v in row)


def difference(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None. Row order does not count; values must be equal."""
    relation = connection.sql(sql)
    expected_types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    actual_types = {name: SPARK_TO_DUCKDB.get(kind, kind) for name, kind in df.dtypes}
    if actual_types != expected_types:
        wrong = set(actual_types.items()) ^ set(expected_types.items())
        return f"columns differ: {sorted(wrong)}"
    names = sorted(actual_types)
    actual = sorted((tuple(row[n] for n in names) for row in df.collect()), key=_key)
    order = [relation.columns.index(n) for n in names]
    expected = sorted((tuple(row[i] for i in order) for row in relation.fetchall()), key=_key)
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    for got, want in zip(actual, expected, strict=True):
        if got != want:
            return f"{names}: got {got}, expected {want}"
    return None


def run(spark: SparkSession, sf_dir: str, only: list[str] | None = None) -> int:
    connection = duckdb_over(sf_dir)
    failures = 0
    for name, query in QUERIES.items():
        if only and name not in only:
            continue
        began = time.monotonic()
        try:
            if name in ORACLE_SQL:
                problem = difference(query(spark, sf_dir), connection, ORACLE_SQL[name])
                verdict = "equal" if problem is None else problem
            else:
                rows = query(spark, sf_dir).count()
                problem = None if rows else "no rows"
                verdict = f"{rows} rows (no SQL twin)"
        except Exception as error:
            problem = verdict = f"{type(error).__name__}: {str(error)[:1500]}"
        failures += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name:26s} {time.monotonic() - began:6.2f}s  {verdict}", flush=True)
    print(f"{failures} failures, at {datetime.datetime.now():%H:%M:%S}")
    return failures


def main() -> None:
    from swishline.session import local_session

    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--dir", default="/root/testdata/sf0.01")
    parser.add_argument("--only", nargs="*")
    args = parser.parse_args()
    raise SystemExit(run(local_session(), args.dir, args.only) > 0)


if __name__ == "__main__":
    main()
