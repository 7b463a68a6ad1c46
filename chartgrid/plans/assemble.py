"""The hourly wide table (K10), per-stay matrix (K11) and sequences (K12).

``IcuPipeline`` builds every stage from one :class:`IcuSources`; only the stages
a result needs are planned.  Join layout of the wide table: the
grid and the three stay-level sides (vitals, coma score, urine) are keyed
``(icustay_id, hr)``; the two admission-level sides (arterial gas, labs) are
first mapped onto the kept stays of their admission, so all five left joins
use the same key and the aggregates' hash partitioning on it is reused
instead of re-shuffling the wide intermediate between joins.

The cohort and the sides are written once to the shared checkpoint folder.  In one
plan the driver would plan, generate and report some 20 shuffles anew whenever one
of them ends, with a copy of the cohort's plan in each branch.
"""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rollup import banded_rollup, stats_rollup
from ..sources.fixtures import IcuSources, slim_sources
from ..sources.io import materialise
from . import concepts as K
from .bloodgas import art_bg
from .cohort import cohort, cohort_hours, kept_stays, stay_bounds
from .gcs import gcs_hourly
from .vitals import labs_hourly, urine_output, vitals

ALL_PARTS = ("vit", "gcs", "uo", "bg", "lab")
#: Hours of the published per-stay matrices.
SPANS = (6, 12, 24, 48)


def chart_codes() -> list:
    """Every chart item code the chain reads (stay bounds, coma score,
    vitals, charted SpO2 and FiO2)."""
    out = []
    for codes in (K.HEART_RATE_CODES, K.GCS_CODES, K.VITAL_CODES, K.SPO2_CODES, K.FIO2_CODES):
        out.extend(c for c in codes if c not in out)
    return out


def lab_and_gas_codes() -> list:
    out = list(K.BLOOD_GAS_CODES)
    for _, codes, _, _ in K.LABS:
        out.extend(c for c in codes if c not in out)
    return out


class IcuPipeline:
    def __init__(self, src: IcuSources, null_safe_error: bool = False, persist: bool = True,
                 share_scans: bool = False):
        self.src = src
        self.null_safe_error = null_safe_error
        self._persist = persist
        self._share = share_scans
        self._shared = False
        self._sides: dict[str, DataFrame] = {}

    def _share_scans(self) -> None:
        """Before a multi-side result, optionally read each event table once
        (persisted item/column slice) instead of once per side.  Off by
        default: with selective pushed-down scans, re-reading measured
        cheaper than building the cache (see PLANS.md)."""
        if not self._share or self._shared:
            return
        self.src = slim_sources(self.src, chart_codes(), lab_and_gas_codes(), K.URINE_CODES)
        for name in ("bounds", "cohort", "kept", "grid", "vitals", "gcs", "urine", "labs", "art_bg"):
            self.__dict__.pop(name, None)
        self._sides.clear()
        self._shared = True

    def unpersist(self) -> None:
        """Release the persisted slices."""
        for df in (self.src.chartevents, self.src.labevents):
            if df.storageLevel.useMemory | df.storageLevel.useDisk:
                df.unpersist()

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        return materialise(df, name) if self._persist else df

    @cached_property
    def bounds(self) -> DataFrame:
        return stay_bounds(self.src)

    @cached_property
    def cohort(self) -> DataFrame:
        return self._keep(cohort(self.src, self.bounds), "cohort")

    @cached_property
    def kept(self) -> DataFrame:
        return kept_stays(self.cohort)

    @cached_property
    def grid(self) -> DataFrame:
        return cohort_hours(self.kept)

    @cached_property
    def vitals(self) -> DataFrame:
        return vitals(self.src.chart(K.VITAL_CODES), self.kept, self.null_safe_error)

    @cached_property
    def gcs(self) -> DataFrame:
        return gcs_hourly(self.src.chart(K.GCS_CODES), self.kept, self.null_safe_error)

    @cached_property
    def urine(self) -> DataFrame:
        return urine_output(self.src.outputevents, self.kept)

    @cached_property
    def labs(self) -> DataFrame:
        return labs_hourly(self.src.labs([c for _, codes, _, _ in K.LABS for c in codes]), self.kept)

    @cached_property
    def art_bg(self) -> DataFrame:
        return art_bg(self.src.labs(K.BLOOD_GAS_CODES), self.src.chart(K.SPO2_CODES + K.FIO2_CODES), self.kept)

    def _per_stay(self, hadm_side: DataFrame) -> DataFrame:
        """Map an (hadm_id, hr) side onto every kept stay of the admission."""
        return hadm_side.join(self.kept.select("hadm_id", "icustay_id"), "hadm_id").drop("hadm_id")

    def _side(self, part: str) -> DataFrame:
        """A side of the hourly table, at most one row per (stay, hr), kept on first use."""
        if part not in self._sides:
            of = {
                "vit": lambda: self.vitals,
                "gcs": lambda: self.gcs,
                "uo": lambda: self.urine,
                "bg": lambda: self._per_stay(self.art_bg.drop("charttime")),
                "lab": lambda: self._per_stay(self.labs),
            }
            self._sides[part] = self._keep(of[part](), f"hourly-{part}")
        return self._sides[part]

    def hourly(self, parts=ALL_PARTS) -> DataFrame:
        """(subject_id, hadm_id, icustay_id, hr) + 40 features, one row per
        grid hour; NULL = not measured.  ``parts`` limits the sides included
        (columns of absent sides are NULL).

        Plan: instead of a chain of five left joins (five exchanges + sorts
        of the growing wide row), the grid and the five sides -- each at most
        one row per (stay, hr) after its own pre-aggregation -- are unioned,
        hash-partitioned once by ``icustay_id`` and collapsed with one hash
        aggregate (``max`` picks the single value of each side).  Groups
        without a grid row are dropped, which is the left-join semantics.
        The ``icustay_id`` partitioning also satisfies the per-stay roll-up
        of :meth:`matrix`, so that aggregate needs no further shuffle.  A
        stay contributes at most (hours x sides) rows to the shuffle, so even
        a stay holding a large share of the raw events is bounded here.
        """
        self._share_scans()
        frames = [self.grid.select("icustay_id", "hr", "subject_id", "hadm_id",
                                   F.lit(1).alias("__grid"))]
        names = {}
        for p in ALL_PARTS:
            if p not in parts:
                continue
            side = self._side(p)
            ren = {c: f"{p}__{c}" for c in side.columns if c not in ("icustay_id", "hr")}
            names[p] = ren
            frames.append(side.select("icustay_id", "hr",
                                      *[F.col(c).alias(n) for c, n in ren.items()]))
        u = frames[0]
        for f in frames[1:]:
            u = u.unionByName(f, allowMissingColumns=True)
        value_cols = [c for c in u.columns if c not in ("icustay_id", "hr")]
        df = (u.repartition("icustay_id")
                .groupBy("icustay_id", "hr").agg(*[F.max(c).alias(c) for c in value_cols])
                .where(F.col("__grid") == 1))

        def col(part, c):
            return F.col(names[part][c]) if part in names else F.lit(None).cast("double")

        prec = {out: F.coalesce(*[col(p, c) for p, c in srcs]) for out, srcs in K.PRECEDENCE}
        sel = [F.col(c) for c in K.HOURLY_KEYS]
        for f in K.HOURLY_FEATURES:
            if f in prec:
                e = prec[f]
            elif f in ("heartrate", "sysbp", "diasbp", "meanbp", "resprate"):
                e = col("vit", f)
            elif f in ("gcs", "gcsmotor", "gcsverbal", "gcseyes"):
                e = col("gcs", f)
            elif f == "endotrachflag":
                e = col("gcs", f) if "gcs" in names else F.lit(None).cast("int")
            elif f.startswith("bg_"):
                e = col("bg", f[3:])
            elif f == "calcium":
                e = col("bg", "calcium")
            elif f == "urineoutput":
                e = col("uo", "urineoutput")
            else:
                e = col("lab", f)
            sel.append(e.alias(f))
        return df.select(*sel)

    def matrix(self, hours: int = 48) -> DataFrame:
        """One row per kept stay: carried stay attributes, mean/min/max of the
        hourly features over hours [0, ``hours``] and total urine output.
        Aggregates first, then attaches the (functionally dependent) stay
        attributes with a one-row-per-stay join."""
        h = self.hourly().where(F.col("hr").between(0, hours))
        stats = {"mean": K.MATRIX_VITALS + K.MATRIX_GCS + K.MATRIX_LABS,
                 "min": K.MATRIX_VITALS + K.MATRIX_GCS + K.MATRIX_LABS,
                 "max": K.MATRIX_VITALS + K.MATRIX_GCS + K.MATRIX_LABS}
        ren = {c: c[3:] for c in K.MATRIX_LABS if c.startswith("bg_")}
        agg = stats_rollup(h, ["subject_id", "hadm_id", "icustay_id"], stats,
                           sums=["urineoutput"], rename=ren)
        attrs = self.cohort.select("icustay_id", *K.MATRIX_CARRIED)
        return agg.join(attrs, "icustay_id").select(
            "subject_id", "hadm_id", "icustay_id", *K.MATRIX_CARRIED,
            *[c for c in agg.columns if c not in ("subject_id", "hadm_id", "icustay_id")])

    def spans(self, hours=SPANS) -> DataFrame:
        """:meth:`matrix` for several spans from one pass over the hourly table, the span
        in ``hours``.  The state rows keep the ``icustay_id`` partitioning of the hourly
        table, so the merge needs no further exchange."""
        cols = K.MATRIX_VITALS + K.MATRIX_GCS + K.MATRIX_LABS
        ren = {c: c[3:] for c in K.MATRIX_LABS if c.startswith("bg_")}
        keys = ["subject_id", "hadm_id", "icustay_id"]
        agg = banded_rollup(self.hourly(), keys, "hr", hours, {"mean": cols, "min": cols, "max": cols},
                            sums=["urineoutput"], rename=ren)
        attrs = self.cohort.select("icustay_id", *K.MATRIX_CARRIED)
        return agg.join(attrs, "icustay_id").select(
            *keys, "hours", *K.MATRIX_CARRIED, *[c for c in agg.columns if c not in (*keys, "hours")])

    def sequences(self, hours: int = 24) -> DataFrame:
        """(icustay_id, hr) in [0, ``hours``] with the six vitals used by the
        sequence model and the outcome label."""
        h = self.hourly(parts=("vit", "bg")).where(F.col("hr").between(0, hours))
        lab = self.cohort.select("icustay_id", "hospital_expire_flag")
        return h.join(lab, "icustay_id").select("icustay_id", "hr", *K.SEQUENCE_FEATURES,
                                                "hospital_expire_flag")
