"""chartgrid: turn irregular per-entity event records into hourly features,
per-entity matrices, sequences and outcome models with Spark DataFrames.

Layout
------
functions/  column-level helpers (hour arithmetic, limits, logistic score)
sources/    table readers, CSV/Parquet sinks, ICU-shaped views over test tables
operators/  generic DataFrame operators (pivot, grid, as-of, carry, best row,
            roll-up, sequence windows, data quality, sampling, metrics)
plans/      the clinical pipelines composed from the operators
ml/         Spark ML feature pipeline, tree models, tuning, sequence classifier
streaming/  incremental (Structured Streaming) form of the hourly pivots
"""

__version__ = "0.1.0"
