"""Feature pipeline for the per-stay matrix (M1-M5): categorical index +
one-hot, median imputation, vector assembly."""
from __future__ import annotations

from typing import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATEGORICAL = ("ethnicity", "gender", "admission_type")
ID_COLUMNS = ("subject_id", "hadm_id", "icustay_id", "dbsource", "expire_flag",
              "deathtime_hours", "hosp_deathtime_hours")


def prepare_matrix(df: DataFrame, label: str = "hospital_expire_flag",
                   categorical: Sequence[str] = CATEGORICAL, keep=("icustay_id",)) -> DataFrame:
    """Rename the label, fill missing categories with 'missing' and cast
    integer features to double (by type, not by type-name string)."""
    drop = [c for c in ID_COLUMNS if c in df.columns and c not in keep]
    out = df.drop(*drop).withColumnRenamed(label, "label")
    out = out.fillna("missing", subset=[c for c in categorical if c in out.columns])
    ints = [f.name for f in out.schema.fields
            if isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType))
            and f.name not in ("label", *keep)]
    return out.withColumns({c: F.col(c).cast("double") for c in ints}) \
              .withColumn("label", F.col("label").cast("double"))


def numeric_columns(df: DataFrame, exclude=("label", "icustay_id")) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def without_values(train: DataFrame, cols: Sequence[str]) -> list[str]:
    """Columns without any value in ``train``, for which no median exists.  One
    aggregate row."""
    if not cols:
        return []
    row = train.agg(*[F.count(F.col(c)).alias(c) for c in cols]).first()
    return [c for c in cols if not row[c]]


def feature_pipeline(categorical: Sequence[str], numeric: Sequence[str]) -> Pipeline:
    stages = []
    for c in categorical:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=[f"{c}_idx"], outputCols=[f"{c}_vec"]))
    stages.append(Imputer(strategy="median", inputCols=list(numeric),
                          outputCols=[f"imputed_{c}" for c in numeric]))
    stages.append(VectorAssembler(inputCols=[f"{c}_vec" for c in categorical]
                                  + [f"imputed_{c}" for c in numeric], outputCol="features"))
    return Pipeline(stages=stages)
