"""Small helpers shared by the oracle SQL texts."""
from __future__ import annotations


def r9(expr: str) -> str:
    """Round a double to 9 places the same way in any engine (absorbs
    summation-order noise of parallel aggregates)."""
    return f"(round(({expr}) * 1e9) / 1e9 + CAST(0.0 AS DOUBLE))"


def rounded(sql: str, cols) -> str:
    """Wrap a query so the listed double columns are rounded to 9 places."""
    cols = list(cols)
    if not cols:
        return sql
    rep = ", ".join(f"{r9(c)} AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS q"


def in_list(codes) -> str:
    return "(" + ", ".join(str(c) for c in codes) + ")"


def dbl(x) -> str:
    return f"CAST({x!r} AS DOUBLE)"
