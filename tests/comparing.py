"""Run a registered query and its SQL counterpart on the same files and compare the rows."""

from __future__ import annotations

import collections
import glob
import os

import duckdb


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return collections.Counter(
        tuple(f"{v:.10g}" if isinstance(v, float) else str(v) for v in (row[i] for i in order))
        for row in rows
    )


KINDS = {"LongType()": "BIGINT", "DoubleType()": "DOUBLE", "StringType()": "VARCHAR",
         "TimestampNTZType()": "TIMESTAMP", "IntegerType()": "INTEGER", "BooleanType()": "BOOLEAN"}


def compare(spark, connection, folder, query, sql) -> tuple[int, list[str]]:
    """Rows produced, and what differs (nothing if the two agree)."""
    frame = query(spark, folder)
    ours = frame.collect()
    relation = connection.sql(sql)
    theirs = relation.fetchall()
    problems = []
    if sorted(frame.columns) != sorted(relation.columns):
        problems.append(f"columns {sorted(frame.columns)} != {sorted(relation.columns)}")
        return len(ours), problems
    spark_kinds = {f.name: KINDS.get(repr(f.dataType), repr(f.dataType)) for f in frame.schema}
    sql_kinds = dict(zip(relation.columns, map(str, relation.types)))
    if spark_kinds != sql_kinds:
        problems.append(f"types {spark_kinds} != {sql_kinds}")
    left, right = rows_of(frame.columns, ours), rows_of(relation.columns, theirs)
    if left != right:
        extra, missing = left - right, right - left
        problems.append(
            f"{sum(extra.values())} rows only in Spark {list(extra)[:3]}, "
            f"{sum(missing.values())} only in SQL {list(missing)[:3]}"
        )
    return len(ours), problems
