"""Conditional-aggregation pivot: event-attribute-value rows -> wide columns.

A :class:`Concept` is one output column: the codes that feed it, per-code
validity limits (values outside become NULL), an optional transform (unit
conversion, sentinel mapping) and the aggregate.  ``pivot_agg`` turns a list
of concepts into a single ``groupBy().agg()`` with one ``agg(CASE ...)`` per
column, so Spark plans one partial (map-side) + one final hash aggregate and
a single shuffle on the group keys, however many columns are produced.
Unlike ``groupBy().pivot()`` the output schema is fixed and each column has
its own rule.

The greatest or least of a text has no place in a hash aggregate: one such column
among others makes Spark sort all rows of all codes by the keys.  Where both kinds
occur the texts are aggregated by themselves, over the rows of their codes only, and
joined to the wide row (NULL keys match, they are groups like any other).
"""
from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    """Codes whose value is taken when it lies in the (lo, hi) interval."""
    codes: tuple
    lo: float | None = None
    hi: float | None = None
    lo_inclusive: bool = False
    hi_inclusive: bool = False
    transform: str | None = None       # SQL text with {v} for the value


@dataclass(frozen=True)
class Concept:
    name: str
    rules: tuple
    agg: str = "avg"              # avg | max | min | sum | count
    value_col: str = "valuenum"

    @staticmethod
    def simple(name, codes, lo=None, hi=None, lo_inclusive=False, hi_inclusive=False,
               agg="avg", value_col="valuenum", transform=None) -> "Concept":
        return Concept(name, (Rule(tuple(codes), lo, hi, lo_inclusive, hi_inclusive, transform),),
                       agg, value_col)

    @property
    def codes(self) -> tuple:
        out = []
        for r in self.rules:
            out.extend(c for c in r.codes if c not in out)
        return tuple(out)


def concept_sql(concept: Concept, code_col: str = "itemid") -> str:
    """The CASE text of this concept's value for one row (or NULL).  One text per
    column: building it from column objects costs a JVM call per literal."""
    v = concept.value_col
    branches = []
    for r in concept.rules:
        codes = ", ".join("'" + c.replace("'", "\\'") + "'" if isinstance(c, str) else str(c) for c in r.codes)
        tests = [f"{code_col} IN ({codes})"]
        if r.lo is not None:
            tests.append(f"{v} {'>=' if r.lo_inclusive else '>'} {float(r.lo)!r}D")
        if r.hi is not None:
            tests.append(f"{v} {'<=' if r.hi_inclusive else '<'} {float(r.hi)!r}D")
        branches.append(f"WHEN {' AND '.join(tests)} THEN {r.transform.format(v=v) if r.transform else v}")
    return f"CASE {' '.join(branches)} END"


def concept_value(concept: Concept, code_col: str = "itemid") -> Column:
    return F.expr(concept_sql(concept, code_col))


def all_codes(concepts: Sequence[Concept]) -> list:
    out: list = []
    for c in concepts:
        out.extend(x for x in c.codes if x not in out)
    return out


def pivot_agg(df: DataFrame, keys: Sequence[str], concepts: Sequence[Concept],
              code_col: str = "itemid", extra_aggs: Sequence[Column] = ()) -> DataFrame:
    """``groupBy(keys)`` with one conditional aggregate per concept."""
    keys = list(keys)
    aggs = {c.name: F.expr(f"{c.agg}({concept_sql(c, code_col)}) AS {c.name}") for c in concepts}
    texts = [c for c in concepts if c.agg in ("max", "min") and isinstance(df.schema[c.value_col].dataType, T.StringType)]
    if not texts or len(texts) == len(concepts):
        return df.groupBy(*keys).agg(*aggs.values(), *extra_aggs)
    apart = {c.name for c in texts}
    wide = df.groupBy(*keys).agg(*[a for n, a in aggs.items() if n not in apart], *extra_aggs)
    some = reduce(or_, [F.col(c.value_col).isNotNull() for c in texts])
    text = (df.where(F.col(code_col).isin(*all_codes(texts)) & some).groupBy(*keys)
            .agg(*[aggs[c.name] for c in texts]).withColumnsRenamed({k: f"__k_{k}" for k in keys}))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])
    return wide.join(text, same, "left").select(
        *keys, *aggs, *[c for c in wide.columns if c not in aggs and c not in keys])


def count_code(code, code_col: str = "itemid", value_col: str = "value") -> Column:
    """``count(CASE WHEN code_col = code THEN value END)`` — for HAVING rules."""
    return F.count(F.when(F.col(code_col) == code, F.col(value_col)))
