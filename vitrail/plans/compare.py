"""Result comparison used by the oracle check and the tests: row count, column names and
the order-insensitive multiset of rows with columns sorted by name."""

from __future__ import annotations

import math
from collections import Counter

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(v)
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark_cols, spark_rows, duck_cols, duck_rows) -> str | None:
    """None when equal, else a short description of the first difference."""
    sc, sset = canonical(spark_cols, spark_rows)
    dc, dset = canonical(duck_cols, duck_rows)
    if sc != dc:
        return f"columns differ: spark={sc} duck={dc}"
    if len(spark_rows) != len(duck_rows):
        return f"row counts differ: spark={len(spark_rows)} duck={len(duck_rows)}"
    if sset != dset:
        return (f"values differ: spark-only={list((sset - dset).elements())[:3]} "
                f"duck-only={list((dset - sset).elements())[:3]}")
    return None
