"""ICU-shaped source tables derived from the driver's ``events``/``customer``.

The clinical pipelines read six tables (chartevents, labevents, outputevents,
icustays, admissions, patients).  The test data has none of them, so these
views derive them deterministically from ``events`` (one stay = one user's
10-day block of January 2024, ``hadm_id = user_id``) and ``customer`` (one
admission and one patient per customer).  The same definitions, as portable
SQL, are in :mod:`chartgrid.sources.fixture_sql` for the DuckDB oracle.

The event-attribute-value tables fan every event out to a fixed list of item
codes (``operators.fanout``: a cross join with the literal list, so Spark knows
that the rows multiply) and a plain filter, so the work stays a narrow,
codegen-friendly scan of ``events``.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.fanout import fan_out
from .tables import read_table

# Fixed values of the test fixture (FIXTURES.md §2): item code, low, high of
# the generated numeric value.
CHART_ITEMS = [
    (211, -10, 320), (220045, 40, 180), (51, -5, 420), (220179, 60, 200), (8368, 20, 310),
    (220180, 30, 120), (456, 10, 320), (220052, 40, 130), (618, -2, 80), (220210, 5, 40),
    (678, 60, 125), (223761, 90, 105), (676, 5, 55), (223762, 33, 41), (646, 60, 110),
    (220277, 80, 100), (807, -20, 400), (220621, 50, 300), (223835, 0, 120), (190, 0, 2),
    (3420, 20, 100), (3422, 20, 100), (184, 1, 4), (220739, 1, 4), (454, 1, 6),
    (223901, 1, 6), (723, 1, 5), (223900, 1, 5),
    (442, -5, 420), (455, -5, 420), (6701, -5, 420), (220050, 60, 200), (8440, 20, 310),
    (8441, 20, 310), (8555, 20, 310), (220051, 30, 120), (52, 10, 320), (6702, 10, 320),
    (443, 10, 320), (220181, 40, 130), (225312, 40, 130), (615, -2, 80), (224690, 5, 40),
    (811, -20, 400), (1529, -20, 400), (3745, -20, 400), (3744, -20, 400), (225664, 50, 300), (226537, 50, 300),
]
# item code of an output row by event_id modulo their number (the last is no urine code)
OUTPUT_ITEMS = [
    227489, 226559, 40055, 40069, 43175, 40094, 40715, 40473, 40085, 40057, 40056, 40405,
    40428, 40086, 40096, 40651, 226560, 226561, 226584, 226563, 226564, 226565,
    226567, 226557, 226558, 227488, 99999,
]
# item code, low, high, variant (variant 1 rows exist only for every 20th event)
LAB_ITEMS = [
    (50800, 0, 0, 0), (50800, 0, 0, 1), (50801, 100, 600, 0), (50802, -10, 10, 0),
    (50803, 10, 40, 0), (50804, 10, 45, 0), (50805, 0, 5, 0), (50806, 90, 120, 0),
    (50808, 0, 2, 0), (50809, 50, 300, 0), (50810, 20, 110, 0), (50811, 5, 20, 0),
    (50812, 0, 0, 0), (50813, 0, 60, 0), (50814, 0, 3, 0), (50815, 0, 80, 0),
    (50816, 0, 110, 0), (50817, 50, 105, 0), (50818, 20, 90, 0), (50819, 0, 20, 0),
    (50820, 7, 8, 0), (50821, 20, 900, 0), (50822, 2, 8, 0), (50823, 0, 100, 0),
    (50824, 120, 160, 0), (50825, 34, 41, 0), (50826, 300, 700, 0), (50827, 5, 30, 0),
    (50828, 0, 10, 0), (50868, 5, 30, 0), (50862, 0, 12, 0), (51144, -5, 110, 0),
    (50882, 10, 40, 0), (50885, 0, 160, 0), (50912, 0, 160, 0), (50902, 90, 120, 0),
    (50931, 50, 400, 0), (51221, 20, 110, 0), (51222, 5, 55, 0), (51265, 10, 900, 0),
    (50971, 2, 35, 0), (51275, 20, 160, 0), (51237, 0, 55, 0), (51274, 10, 160, 0),
    (50983, 120, 210, 0), (51006, 5, 320, 0), (51300, 1, 1100, 0), (51301, 1, 1100, 0),
]


def _block(ts: Column) -> Column:
    """0, 1 or 2: which 10-day block of the month the event falls in."""
    return F.floor((F.dayofmonth(ts) - F.lit(1)) / F.lit(10)).cast("bigint")


def _stay_id(user: Column, ts: Column) -> Column:
    return user * F.lit(10) + _block(ts)


def _each_item(events: DataFrame, items) -> DataFrame:
    """Every event with every item, in the struct column ``i`` (itemid, lo, hi, variant)."""
    names = ("itemid", "lo", "hi", "variant")
    rows = [[str(i), f"{float(lo)}D", f"{float(hi)}D", str(variant[0] if variant else 0)] for i, lo, hi, *variant in items]
    return fan_out(events, [f"__{n}" for n in names], rows).select(
        *events.columns, F.struct(*[F.col(f"__{n}").alias(n) for n in names]).alias("i"))


def _of(items, codes):
    """The items with one of the codes (all without codes): the fan-out of a
    reader is cut to what it reads before any row is made."""
    return items if codes is None else [i for i in items if i[0] in set(codes)] or items[:1]


def _spread(e: Column, i: Column, mult: int, imult: int) -> Column:
    """lo + (hi - lo) * ((event_id*mult + itemid*imult) % 1000) / 1000."""
    frac = ((e * F.lit(mult) + i["itemid"] * F.lit(imult)) % F.lit(1000)).cast("double")
    return i["lo"] + (i["hi"] - i["lo"]) * frac / F.lit(1000.0)


def icustays(events: DataFrame) -> DataFrame:
    e = events.select("user_id", "ts")
    blk = _block(F.col("ts"))
    return (e.select(
        F.col("user_id").alias("subject_id"),
        F.col("user_id").alias("hadm_id"),
        _stay_id(F.col("user_id"), F.col("ts")).alias("icustay_id"),
        F.when(F.col("user_id") % 2 == 0, "carevue").otherwise("metavision").alias("dbsource"),
        (F.expr("TIMESTAMP_NTZ'2024-01-01 00:20:00'")
         + F.make_dt_interval((F.lit(10) * blk).cast("int"), (F.col("user_id") % 6).cast("int"))
         ).alias("intime"),
        (F.expr("TIMESTAMP_NTZ'2024-01-11 00:20:00'")
         + F.make_dt_interval((F.lit(10) * blk).cast("int"))).alias("outtime"),
        (F.lit(10.0) - (F.col("user_id") % 6).cast("double") / F.lit(24.0)).alias("los"),
    ).distinct())


def admissions(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        k.alias("hadm_id"),
        (F.expr("TIMESTAMP_NTZ'2023-12-30 00:00:00'")
         + F.make_dt_interval(F.lit(0), (k % 48).cast("int"))).alias("admittime"),
        F.expr("TIMESTAMP_NTZ'2024-01-31 12:00:00'").alias("dischtime"),
        F.when(k % 9 == 0, F.expr("TIMESTAMP_NTZ'2024-01-25 06:30:00'")).alias("deathtime"),
        F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("ethnicity"),
        F.when(k % 3 == 0, "EMERGENCY").when(k % 3 == 1, "ELECTIVE").otherwise("URGENT").alias("admission_type"),
        F.when(k % 9 == 0, 1).otherwise(0).alias("hospital_expire_flag"),
        F.when(k % 29 == 0, 0).otherwise(1).alias("has_chartevents_data"),
        F.when(k % 18 == 0, "Organ Donor").when(k % 25 == 0, "DONOR ACCOUNT")
         .otherwise("SEPSIS").alias("diagnosis"),
    )


def patients(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        k.alias("subject_id"),
        F.when(k % 2 == 0, "F").otherwise("M").alias("gender"),
        (F.expr("TIMESTAMP_NTZ'2023-12-31 00:00:00'")
         - F.make_dt_interval((F.lit(365) * (k % 90)).cast("int"))).alias("dob"),
        F.when(k % 9 == 0, F.expr("TIMESTAMP_NTZ'2024-01-25 00:00:00'"))
         .when(k % 7 == 0, F.expr("TIMESTAMP_NTZ'2024-06-01 00:00:00'")).alias("dod"),
        F.when((k % 9 == 0) | (k % 7 == 0), 1).otherwise(0).alias("expire_flag"),
    )


def chartevents(events: DataFrame, codes=None) -> DataFrame:
    e = events.select("event_id", "user_id", "ts")
    eid = F.col("event_id")
    # fan out to the fixed item list, then a plain (codegen) filter
    x = (_each_item(e, _of(CHART_ITEMS, codes))
          .where((eid * F.lit(31) + F.col("i")["itemid"]) % F.lit(3) == 0))
    i = F.col("i")
    return x.select(
        _stay_id(F.col("user_id"), F.col("ts")).alias("icustay_id"),
        F.col("user_id").alias("hadm_id"),
        F.col("ts").alias("charttime"),
        i["itemid"].alias("itemid"),
        F.when((i["itemid"] == 723) & (eid % 4 == 0), "1.0 ET/Trach")
         .when((i["itemid"] == 223900) & (eid % 4 == 1), "No Response-ETT").alias("value"),
        F.when((eid + i["itemid"]) % 23 == 0, F.lit(None).cast("double"))
         .otherwise(_spread(eid, i, 7919, 37)).alias("valuenum"),
        F.when(eid % 10 == 0, 1).when(eid % 7 == 0, F.lit(None).cast("int")).otherwise(0).alias("error"),
    )


def labevents(events: DataFrame, codes=None) -> DataFrame:
    e = events.select("event_id", "user_id", "ts").where(F.col("event_id") % 2 == 0)
    eid = F.col("event_id")
    x = (_each_item(e, _of(LAB_ITEMS, codes))
          .where((F.col("i")["variant"] == 0) | (eid % 20 == 0)))
    i = F.col("i")
    return x.select(
        F.col("user_id").alias("hadm_id"),
        (F.col("ts") + F.expr("INTERVAL 45 MINUTES")).alias("charttime"),
        i["itemid"].alias("itemid"),
        F.when((i["itemid"] == 50800) & (eid % 6 == 0), "ART")
         .when((i["itemid"] == 50800) & (eid % 6 == 2), "VEN")
         .when((i["itemid"] == 50812) & (eid % 8 == 0), "INTUBATED").alias("value"),
        F.when(i["itemid"].isin(50800, 50812) | ((eid + i["itemid"]) % 11 == 0),
               F.lit(None).cast("double")).otherwise(_spread(eid, i, 7907, 41)).alias("valuenum"),
    )


def outputevents(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    return events.select(
        _stay_id(F.col("user_id"), F.col("ts")).alias("icustay_id"),
        F.col("ts").alias("charttime"),
        F.expr(f"element_at(array({', '.join(map(str, OUTPUT_ITEMS))}), "
               f"cast(event_id % {len(OUTPUT_ITEMS)} as int) + 1)").alias("itemid"),
        F.col("value"),
    )


@dataclass
class IcuSources:
    """The six source tables the clinical pipelines read."""
    chartevents: DataFrame
    labevents: DataFrame
    outputevents: DataFrame
    icustays: DataFrame
    admissions: DataFrame
    patients: DataFrame

    def chart(self, codes) -> DataFrame:
        """Chart rows of some item codes (on stored tables a pushed-down filter)."""
        return self.chartevents.where(F.col("itemid").isin(*codes))

    def labs(self, codes) -> DataFrame:
        """Laboratory rows of some item codes."""
        return self.labevents.where(F.col("itemid").isin(*codes))


@dataclass
class DerivedSources(IcuSources):
    """Views over ``events``: a reader generates the codes that it asks for only."""
    events: DataFrame

    def chart(self, codes) -> DataFrame:
        return chartevents(self.events, codes).where(F.col("itemid").isin(*codes))

    def labs(self, codes) -> DataFrame:
        return labevents(self.events, codes).where(F.col("itemid").isin(*codes))


def slim_sources(src: IcuSources, chart_codes, lab_codes, output_codes=None) -> IcuSources:
    """Scan sharing: the clinical chain reads chartevents five times and
    labevents twice.  Keep only the item codes and columns the chain uses and
    persist (memory, spilling to disk; lost blocks are recomputed from the
    scan), so each large table is scanned once."""
    from pyspark import StorageLevel
    lvl = StorageLevel.MEMORY_AND_DISK
    ce = src.chartevents.where(F.col("itemid").isin(*chart_codes)).select(
        "icustay_id", "hadm_id", "charttime", "itemid", "value", "valuenum", "error").persist(lvl)
    le = src.labevents.where(F.col("itemid").isin(*lab_codes)).select(
        "hadm_id", "charttime", "itemid", "value", "valuenum").persist(lvl)
    oe = src.outputevents
    if output_codes is not None:
        oe = oe.where(F.col("itemid").isin(*output_codes))
    return IcuSources(chartevents=ce, labevents=le, outputevents=oe, icustays=src.icustays,
                      admissions=src.admissions, patients=src.patients)


def icu_sources(spark: SparkSession, sf_dir: str) -> IcuSources:
    """ICU-shaped views over ``sf_dir``'s ``events`` and ``customer``."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value"])
    cu = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    return DerivedSources(chartevents=chartevents(ev), labevents=labevents(ev),
                          outputevents=outputevents(ev), icustays=icustays(ev),
                          admissions=admissions(cu), patients=patients(cu), events=ev)
