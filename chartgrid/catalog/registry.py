"""All registered queries and oracles."""
from __future__ import annotations


def all_queries() -> dict:
    from . import clinical, metrics, ml, model_metrics, ops, seq, streams
    out = {}
    out.update(clinical.QUERIES)
    out.update(ops.QUERIES)
    out.update(seq.QUERIES)
    out.update(metrics.QUERIES)
    out.update(ml.QUERIES)
    out.update(model_metrics.QUERIES)
    out.update(streams.QUERIES)
    return out


def all_oracles() -> dict:
    from . import clinical_sql, metrics_sql, ops_sql, seq_sql
    out = {}
    out.update(clinical_sql.oracles())
    out["vitals_stream"] = out["vitals"]  # same result as the batch form
    out.update(ops_sql.oracles())
    out.update(seq_sql.oracles())
    out.update(metrics_sql.oracles())
    return out
