"""Run a query and its SQL on the same tables and compare all rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb
from pyspark.sql import SparkSession

from weir.catalog import Query


def tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def rows(columns: list[str], records) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr)


def compare(spark: SparkSession, connection, query: Query, sf_dir: str) -> int:
    """Number of rows, after asserting that both sides have the same."""
    df = query.run(spark, sf_dir)
    ours = rows(df.columns, df.collect())
    result = connection.execute(query.sql)
    names = [c[0] for c in result.description]
    theirs = rows(names, result.fetchall())
    assert sorted(df.columns) == sorted(names)
    assert len(ours) == len(theirs), f"{len(ours)} rows, SQL gives {len(theirs)}"
    different = [(a, b) for a, b in zip(ours, theirs, strict=True) if a != b]
    assert not different, f"{len(different)} rows differ, first: {different[0]}"
    types = {tuple(type(v).__name__ for v in r) for r in ours[:50]}, {tuple(type(v).__name__ for v in r) for r in theirs[:50]}
    assert types[0] == types[1], f"types {types}"
    return len(ours)
