"""Run a catalog query on Spark and its SQL on DuckDB and compare all values."""

from __future__ import annotations

import sys
import time
from collections import Counter
from datetime import datetime
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _rows(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(str(row[i]) for i in order) for row in rows)


# Spark type names and their DuckDB counterparts.
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
}


def _types(fields: list[tuple[str, str]]) -> dict[str, str]:
    return {name: SAME_TYPE.get(kind, kind.upper()) for name, kind in fields}


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same columns, types and rows."""
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    expected_types = {d[0]: str(d[1]) for d in answer.description}
    expected = _rows(names, answer.fetchall())
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    types = _types(df.dtypes)
    if types != {k: v.replace(" ", "") for k, v in expected_types.items()}:
        return f"types differ: spark {types} sql {expected_types}"
    if actual != expected:
        return (
            f"rows differ: spark {actual.total()} sql {expected.total()}; "
            f"only spark {list((actual - expected).items())[:2]}; "
            f"only sql {list((expected - actual).items())[:2]}"
        )
    return None


def main(sf_dir: str, only: list[str]) -> int:
    from pyspark.sql import SparkSession

    from vigilmart import settings
    from vigilmart.plans.catalog import QUERIES
    from vigilmart.plans.oracles import ORACLES

    builder = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
    builder = builder.config("spark.ui.showConsoleProgress", "false")
    spark = settings.tuned(builder, 8).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in only or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                problem = difference(df, con, ORACLES[name])
            else:
                problem = f"(no SQL) {df.count()} rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None and not problem.startswith("(no SQL)")
        print(f"{datetime.now():%H:%M:%S} {name} {time.time() - start:.2f}s {problem or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
