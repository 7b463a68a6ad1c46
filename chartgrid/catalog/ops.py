"""Spark side of the single-operator keys over the raw tables and the
ICU-shaped views (scans, filters, joins, windows, scalars, set ops, top-k)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import add_hours, ceil_hour, day_diff, floor_hour, hour_diff, second_diff
from ..functions.scalar import in_range, ne_3vl, round_half_away
from ..operators.asof import asof_lookback
from ..operators.carry import carry_previous
from ..operators.pivot import Concept, concept_value, count_code, pivot_agg
from ..operators.rank import best_per_group, last_per_group, ordinal_skew_safe
from ..plans import concepts as K
from ..plans.bloodgas import fio2_charted
from ..plans.cohort import rows_in_stay_window
from ..plans.gcs import canonicalise
from ..plans.vitals import plausibility_clip
from ..sources.fixtures import icu_sources
from ..sources.io import materialise, read_csv, write_csv
from ..sources.tables import read_table
from ..session import scratch_path
from .common import rounded


def _t(spark, sf, name, cols=None):
    return read_table(spark, sf, name, cols)


def q_scan_project(spark, sf):
    li = _t(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                     "l_discount", "l_tax", "l_returnflag"])
    out = (li.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"),
                     F.col("l_quantity").alias("qty"),
                     (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("revenue"),
                     "l_tax", "l_returnflag")
           .drop("l_tax").withColumnRenamed("l_returnflag", "returnflag"))
    return rounded(out)


def q_io_roundtrip(spark, sf):
    o = _t(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"])
    path = scratch_path(spark, "io_roundtrip")
    o.write.mode("overwrite").partitionBy("o_orderstatus").parquet(path)
    back = spark.read.parquet(path)
    return rounded(back.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"))


def q_csv_roundtrip(spark, sf):
    from pyspark.sql import types as T
    adm = icu_sources(spark, sf).admissions.select("hadm_id", "ethnicity", "admission_type",
                                                   "hospital_expire_flag")
    path = write_csv(adm, scratch_path(spark, "csv_roundtrip"))
    schema = T.StructType([T.StructField("hadm_id", T.LongType()),
                           T.StructField("ethnicity", T.StringType()),
                           T.StructField("admission_type", T.StringType()),
                           T.StructField("hospital_expire_flag", T.IntegerType())])
    return read_csv(spark, path, schema=schema)


def q_csv_inferred(spark, sf):
    """The admissions as a CSV table whose types are inferred from all of its rows."""
    adm = icu_sources(spark, sf).admissions.select("hadm_id", "admittime", "admission_type", "hospital_expire_flag")
    path = write_csv(adm, scratch_path(spark, "csv_inferred"))
    back = read_csv(spark, path, infer_schema=True)
    kinds = dict(back.dtypes)
    return back.select("*", *[F.lit(kinds[c]).alias(f"{c}_type") for c in adm.columns])


def q_filter_in_list(spark, sf):
    ce = icu_sources(spark, sf).chartevents
    return rounded(ce.where(F.col("itemid").isin(*K.VITAL_CODES))
                   .select("icustay_id", "charttime", "itemid", "valuenum"))


def q_filter_range(spark, sf):
    li = _t(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_discount", "l_quantity"])
    return rounded(li.where(in_range("l_discount", 0.02, 0.06, hi_inclusive=True)
                            & F.col("l_quantity").between(10, 20)))


def q_filter_three_valued(spark, sf):
    ce = icu_sources(spark, sf).chartevents
    return ce.where(ne_3vl("error", 1)).select("icustay_id", "charttime", "itemid", "error")


def q_flag_columns(spark, sf):
    o = _t(spark, sf, "orders", ["o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus"])
    flag = lambda c: F.when(c, 1).otherwise(0)
    return o.select("o_orderkey",
                    flag(F.col("o_totalprice") > 100000).alias("high_value"),
                    flag(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias("urgent"),
                    flag((F.col("o_orderstatus") == "F") | (F.col("o_totalprice") < 1000)).alias("closed_or_small"))


def q_fio2_normalise(spark, sf):
    return rounded(fio2_charted(icu_sources(spark, sf).chartevents))


def q_like_filter(spark, sf):
    adm = icu_sources(spark, sf).admissions
    d = F.lower(F.col("diagnosis"))
    return adm.where(d.like("%organ donor%") | d.like("%donor account%")).select("hadm_id", "diagnosis")


def q_code_to_concept(spark, sf):
    return rounded(canonicalise(icu_sources(spark, sf).chartevents))


def q_plausibility_clip(spark, sf):
    return rounded(plausibility_clip(icu_sources(spark, sf).labevents))


def q_unit_convert(spark, sf):
    ce = icu_sources(spark, sf).chartevents
    temp = [c for c in K.VITALS if c.name == "tempc"][0]
    return rounded(ce.where(F.col("itemid").isin(*temp.codes))
                   .select("icustay_id", "charttime", "itemid", concept_value(temp).alias("tempc")))


def q_interval_join(spark, sf):
    return rows_in_stay_window(icu_sources(spark, sf))


def q_semi_join(spark, sf):
    o = _t(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    ev = _t(spark, sf, "events", ["user_id"])
    return o.join(ev.withColumnRenamed("user_id", "o_custkey"), "o_custkey", "left_semi")


def q_id_intersect(spark, sf):
    c = _t(spark, sf, "customer", ["c_custkey"]).select(F.col("c_custkey").alias("id"))
    o = _t(spark, sf, "orders", ["o_custkey"]).select(F.col("o_custkey").alias("id"))
    e = _t(spark, sf, "events", ["user_id"]).select(F.col("user_id").alias("id"))
    return c.intersect(o).intersect(e)


def q_stay_ordinal(spark, sf):
    # a fact table: one customer may hold a large share of the orders
    o = _t(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    return ordinal_skew_safe(o, ["o_custkey"], "o_orderdate", ["o_orderkey"],
                             "ordinal").select("o_orderkey", "o_custkey", "ordinal")


def _ship(spark, sf):
    li = _t(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice",
                                     "l_quantity", "l_discount"])
    o = _t(spark, sf, "orders", ["o_orderkey", "o_orderdate"])
    return li.join(o, li.l_orderkey == o.o_orderkey).drop("o_orderkey")


def q_hour_diff(spark, sf):
    j = _ship(spark, sf)
    return j.select("l_orderkey", "l_linenumber", hour_diff("l_shipdate", "o_orderdate").alias("hours"))


def q_time_scalars(spark, sf):
    j = _ship(spark, sf)
    return j.select("l_orderkey", "l_linenumber",
                    floor_hour("l_shipdate").alias("ship_hour"),
                    ceil_hour("l_shipdate").alias("ship_hour_up"),
                    add_hours("o_orderdate", 2).alias("order_plus_2h"),
                    (F.col("o_orderdate") - F.expr("INTERVAL 12 HOURS")).alias("order_minus_12h"),
                    day_diff("l_shipdate", "o_orderdate").cast("bigint").alias("days"),
                    second_diff("l_shipdate", "o_orderdate").alias("seconds"))


def q_math_scalars(spark, sf):
    li = _t(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity",
                                     "l_discount"])
    return rounded(li.select(
        "l_orderkey", "l_linenumber",
        round_half_away(F.col("l_extendedprice") / F.col("l_quantity"), 4).alias("unit_price"),
        (F.col("l_discount") * F.lit(100.0) / F.lit(60.0) / F.lit(24.0)).alias("ratio"),
        round_half_away(F.col("l_extendedprice") / F.lit(365.242), 4).alias("per_day"),
        F.exp(-F.col("l_discount")).alias("decay")))


def _events(spark, sf):
    return _t(spark, sf, "events", ["event_id", "ts", "user_id", "event_type", "value"])


def q_asof_lookback(spark, sf):
    ev = _events(spark, sf)
    left = ev.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    right = ev.where(F.col("event_type") == "click").select("user_id", "ts", F.col("value").alias("click_value"))
    return rounded(asof_lookback(left, right, ["user_id"], "ts", "ts", ["click_value"], 24 * 3600,
                                 match_time_col="click_ts"))


def q_asof_lookback_filtered(spark, sf):
    ev = _events(spark, sf)
    left = ev.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    right = (ev.where((F.col("event_type") == "click") & (F.col("value") > 100))
             .select("user_id", "ts", F.col("value").alias("click_value")))
    return rounded(asof_lookback(left, right, ["user_id"], "ts", "ts", ["click_value"], 4 * 3600,
                                 match_time_col="click_ts"))


def q_carry_previous(spark, sf):
    ev = _events(spark, sf).select("event_id", "user_id", "ts", "event_type", "value")
    c = carry_previous(ev, ["user_id"], "ts", ["value", "event_type"], 6 * 3600, strict=True)
    return rounded(c.select("event_id", "user_id", "ts", "value", "prev_value", "prev_event_type"))


def q_best_per_group(spark, sf):
    ev = _events(spark, sf).withColumn("day", F.to_date("ts"))
    b = best_per_group(ev, ["user_id", "day"], [("value", False), ("event_type", True), ("ts", False)],
                       ["event_id", "event_type", "value", "ts"])
    return rounded(b)


def q_last_in_hour(spark, sf):
    ev = _events(spark, sf).withColumn("hour", floor_hour("ts"))
    return rounded(last_per_group(ev, ["user_id", "hour"], "ts", ["event_id", "value"]))


def q_having_count(spark, sf):
    ev = _events(spark, sf).withColumn("day", F.to_date("ts"))
    cs = [Concept.simple(f"{t}_value", (t,), value_col="value") for t in
          ("click", "view", "purchase", "signup", "error")]
    p = pivot_agg(ev, ["user_id", "day"], cs, code_col="event_type",
                  extra_aggs=[count_code("purchase", "event_type", "value").alias("__n")])
    return rounded(p.where(F.col("__n") < 2).drop("__n"))


def q_order_output(spark, sf):
    o = _t(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    return o.orderBy("o_orderdate", "o_orderkey")


def q_order_proof(spark, sf):
    """Rows and order of ``order_output`` and ``topk`` as they stand, not as a set."""
    from ..operators.ordering import ordering
    orders = ordering(q_order_output(spark, sf), [("o_orderdate", True), ("o_orderkey", True)])
    top = ordering(q_topk(spark, sf), [("p_retailprice", True), ("p_partkey", False)])
    return (orders.select(F.lit("order_output").alias("result"), "n_rows", "in_order")
            .unionByName(top.select(F.lit("topk").alias("result"), "n_rows", "in_order")))


def q_head_n(spark, sf):
    o = _t(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice"])
    return rounded(o.orderBy("o_orderkey").limit(10))


def q_topk(spark, sf):
    p = _t(spark, sf, "part", ["p_partkey", "p_retailprice"])
    top = p.orderBy(F.col("p_retailprice").desc(), F.col("p_partkey").asc()).limit(20)
    return rounded(top.orderBy("p_retailprice", F.col("p_partkey").desc()))


QUERIES = {
    "scan_project": q_scan_project,
    "io_roundtrip": q_io_roundtrip,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_inferred": q_csv_inferred,
    "filter_in_list": q_filter_in_list,
    "filter_range": q_filter_range,
    "filter_three_valued": q_filter_three_valued,
    "flag_columns": q_flag_columns,
    "fio2_normalise": q_fio2_normalise,
    "like_filter": q_like_filter,
    "code_to_concept": q_code_to_concept,
    "plausibility_clip": q_plausibility_clip,
    "unit_convert": q_unit_convert,
    "interval_join": q_interval_join,
    "semi_join": q_semi_join,
    "id_intersect": q_id_intersect,
    "stay_ordinal": q_stay_ordinal,
    "hour_diff": q_hour_diff,
    "time_scalars": q_time_scalars,
    "math_scalars": q_math_scalars,
    "asof_lookback": q_asof_lookback,
    "asof_lookback_filtered": q_asof_lookback_filtered,
    "carry_previous": q_carry_previous,
    "best_per_group": q_best_per_group,
    "last_in_hour": q_last_in_hour,
    "having_count": q_having_count,
    "order_output": q_order_output,
    "order_proof": q_order_proof,
    "head_n": q_head_n,
    "topk": q_topk,
}


def q_fill_missing(spark, sf):
    from pyspark.sql import types as T
    from ..operators.quality import columns_of_type
    adm = icu_sources(spark, sf).admissions.select(
        "hadm_id", "ethnicity", "admission_type", "hospital_expire_flag", "has_chartevents_data")
    filled = adm.fillna("missing", subset=["ethnicity", "admission_type"])
    ints = [c for c in columns_of_type(filled, T.IntegerType) if c != "hadm_id"]
    return filled.withColumns({c: F.col(c).cast("double") for c in ints})


def q_coalesce_sources(spark, sf):
    from ..plans.assemble import IcuPipeline
    h = IcuPipeline(icu_sources(spark, sf)).hourly(parts=("vit", "bg", "lab"))
    return rounded(h.select("icustay_id", "hr", *[o for o, _ in K.PRECEDENCE]))


QUERIES["fill_missing"] = q_fill_missing
QUERIES["coalesce_sources"] = q_coalesce_sources
