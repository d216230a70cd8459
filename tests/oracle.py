"""Compare a query with its SQL equivalent run by DuckDB, row by row."""

from __future__ import annotations

import datetime
import math
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_SPARK_TYPES = {
    "BIGINT": "bigint",
    "BOOLEAN": "boolean",
    "DOUBLE": "double",
    "INTEGER": "int",
    "TIMESTAMP": "timestamp",
    "VARCHAR": "string",
}


def connect(sf_dir: str):
    import duckdb

    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return db


def _value(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple((type(r[i]).__name__, _value(r[i])) for i in order) for r in rows)


def difference(df, db, sql: str) -> str | None:
    """None when both give the same rows, else what differs."""
    expected = db.execute(sql)
    expected_names = [d[0] for d in expected.description]
    if sorted(expected_names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(expected_names)}"
    want = _bag(expected_names, expected.fetchall())
    types = {d[0]: _SPARK_TYPES.get(str(d[1]), str(d[1])) for d in expected.description}
    if types != {name: t.replace("timestamp_ntz", "timestamp") for name, t in df.dtypes}:
        return f"types {df.dtypes} != {types}"
    got = _bag(df.columns, [tuple(r) for r in df.collect()])
    if got == want:
        return None
    return (
        f"{sum(got.values())} rows, expected {sum(want.values())}; "
        f"only in Spark {list((got - want).items())[:3]}; only in SQL {list((want - got).items())[:3]}"
    )
