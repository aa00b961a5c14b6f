"""Compare a registered Spark query with its DuckDB oracle the way the driver does.

Row count, column names, and the multiset of rows (columns sorted by name,
floats compared exactly after the queries' own rounding).
"""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, float):
        return None if math.isnan(v) else float(v)
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


_SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
                  "smallint": "SMALLINT", "boolean": "BOOLEAN"}


def duck_type(spark_type: str) -> str:
    if spark_type.startswith("array<"):
        return duck_type(spark_type[6:-1]) + "[]"
    return _SPARK_TO_DUCK.get(spark_type, spark_type.upper())


def compare(spark, name, query, sql, sf_dir):
    sdf = query(spark, sf_dir)
    s_types = {f.name: duck_type(f.dataType.simpleString()) for f in sdf.schema.fields}
    s_cols = sdf.columns
    s_rows = rows_of(s_cols, [tuple(r) for r in sdf.collect()])
    rel = duck(sf_dir).sql(sql)
    d_cols = rel.columns
    d_rows = rows_of(d_cols, rel.fetchall())
    problems = []
    d_types = {c: str(t) for c, t in zip(d_cols, rel.types)}
    if s_types != d_types:
        problems.append(f"types {s_types} != {d_types}")
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns {sorted(s_cols)} != {sorted(d_cols)}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows {len(s_rows)} != {len(d_rows)}")
    elif s_rows != d_rows:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b]
        problems.append(f"{len(diff)} differing rows, first: {diff[0]}")
    return problems
