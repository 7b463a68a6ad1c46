"""Text columns of a pivot are aggregated apart from the numeric ones."""
from pyspark.sql import functions as F

from chartgrid.operators.pivot import Concept, concept_value, count_code, pivot_agg

CONCEPTS = [Concept.simple("kind", (1,), agg="max", value_col="value"), Concept.simple("x", (2,), 0, 10),
            Concept.simple("y", (3,)), Concept.simple("tube", (4,), agg="min", value_col="value")]


def _rows(spark):
    return spark.createDataFrame([
        (1, 1, 1, "ART", None), (1, 1, 1, "VEN", None), (1, 1, 2, None, 4.0), (1, 1, 2, None, 6.0), (1, 1, 2, None, 60.0),
        (1, 2, 3, "no code of a text", 5.0), (1, 3, 1, None, None), (2, 1, 4, "b", None), (2, 1, 4, "a", None),
        (None, 1, 1, "ART", None), (None, 1, 2, None, 3.0), (2, None, 1, "VEN", 1.0), (2, None, 1, "VEN", 1.0),
        (None, None, 9, "x", 1.0)], "k int, t int, itemid int, value string, valuenum double")


def test_texts_and_numbers_give_the_rows_of_one_aggregate(spark):
    df = _rows(spark)
    got = pivot_agg(df, ["k", "t"], CONCEPTS, extra_aggs=[count_code(1).alias("n")])
    agg = {"max": F.max, "min": F.min, "avg": F.avg}
    want = df.groupBy("k", "t").agg(*[agg[c.agg](concept_value(c)).alias(c.name) for c in CONCEPTS], count_code(1).alias("n"))
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_numbers_are_not_sorted_for_the_sake_of_a_text(spark):
    plan = pivot_agg(_rows(spark), ["k", "t"], CONCEPTS)._jdf.queryExecution().executedPlan().toString()
    averages = [line for line in plan.splitlines() if "avg(" in line and "Aggregate" in line]
    assert averages and not [line for line in averages if "SortAggregate" in line]
