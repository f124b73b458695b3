"""Compare a Spark DataFrame with a DuckDB SQL result: rows, schema, values.

Mirrors the driver's check: columns sorted by name, rows compared as an
order-insensitive multiset of normalised values (floats exactly).
"""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

SPARK_TO_FAMILY = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def duckdb_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def compare(spark_df, con, sql: str) -> list[str]:
    """Return a list of mismatch descriptions (empty when equal)."""
    problems = []
    s_schema = {f: t for f, t in spark_df.dtypes}
    s_rows = spark_df.collect()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: str(t) for c, t in zip(d_cols, rel.types)}
    d_rows = rel.fetchall()
    if sorted(s_schema) != sorted(d_cols):
        return [f"columns differ: spark={sorted(s_schema)} duckdb={sorted(d_cols)}"]
    for c in s_schema:
        fam = SPARK_TO_FAMILY.get(s_schema[c], s_schema[c])
        if fam != d_types[c]:
            problems.append(f"type of {c}: spark={s_schema[c]} duckdb={d_types[c]}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row count: spark={len(s_rows)} duckdb={len(d_rows)}")
    cols = sorted(s_schema)
    s_idx = [spark_df.columns.index(c) for c in cols]
    d_idx = [d_cols.index(c) for c in cols]
    s_set = sorted(tuple(_norm(r[i]) for i in s_idx) for r in s_rows)
    d_set = sorted(tuple(_norm(r[i]) for i in d_idx) for r in d_rows)
    if s_set != d_set:
        only_s = [r for r in s_set if r not in set(d_set)][:3]
        only_d = [r for r in d_set if r not in set(s_set)][:3]
        problems.append(f"values differ ({cols}); spark-only e.g. {only_s}; duckdb-only e.g. {only_d}")
    return problems
