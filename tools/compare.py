"""Local stand-in for the driver's correctness gate.

Runs a Spark query and its DuckDB oracle on the same Parquet folder and
compares row count, column names and an order-insensitive digest of the
values (doubles rounded to 6 places, columns sorted by name).
"""
from __future__ import annotations

import hashlib
import math
import os

import duckdb

STRICT = bool(os.environ.get("CHECK_STRICT"))

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        r = round(v, 9) if not STRICT else v
        return 0.0 if r == 0 else r
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "toArray"):
        return tuple(_norm(float(x)) for x in v.toArray())
    return v


def rows_digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    normed = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    h = hashlib.sha256(repr(normed).encode()).hexdigest()
    return [cols[i] for i in order], normed, h


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sc, sn, sh = rows_digest(s_cols, s_rows)
    dc, dn, dh = rows_digest(d_cols, d_rows)
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "cols_match": sc == dc, "hash_match": sh == dh}
    if sc != dc:
        out["spark_cols"] = sc
        out["oracle_cols"] = dc
    elif sh != dh:
        sset, dset = set(map(repr, sn)), set(map(repr, dn))
        out["only_spark"] = sorted(sset - dset)[:3]
        out["only_oracle"] = sorted(dset - sset)[:3]
    out["ok"] = out["cols_match"] and out["hash_match"] and len(s_rows) == len(d_rows)
    return out
