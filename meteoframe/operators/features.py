"""Model inputs: vector assembly and standardisation (M4-M6).

``fit_scaling`` fits VectorAssembler + StandardScaler once (on training rows
by default); the fitted stages are shared by all twelve regressors. The SQL
twin ``standardize_columns`` does the same arithmetic as plain columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteoframe.operators import profile

RAW_VECTOR = "features_raw"
VECTOR = "features"


def scaling_pipeline(feature_cols: Sequence[str]) -> Pipeline:
    assembler = VectorAssembler(inputCols=list(feature_cols), outputCol=RAW_VECTOR, handleInvalid="error")
    scaler = StandardScaler(inputCol=RAW_VECTOR, outputCol=VECTOR, withMean=True, withStd=True)
    return Pipeline(stages=[assembler, scaler])


def fit_scaling(train: DataFrame, feature_cols: Sequence[str]) -> PipelineModel:
    """M4 + M5: assemble the feature columns and fit mean/sd on ``train`` (one pass)."""
    return scaling_pipeline(feature_cols).fit(train)


def scaled_columns(scaled: DataFrame, feature_cols: Sequence[str], suffix: str = "_z",
                   digits: int | None = None) -> DataFrame:
    """Unpack the scaled vector into one column per feature."""
    arr = vector_to_array(F.col(VECTOR))
    cols = []
    for i, c in enumerate(feature_cols):
        v = arr[i]
        cols.append((F.round(v, digits) if digits is not None else v).alias(f"{c}{suffix}"))
    return scaled.select(*[c for c in scaled.columns if c not in (VECTOR, RAW_VECTOR)], *cols)


def standardize_columns(df: DataFrame, feature_cols: Sequence[str], fit_on: DataFrame | None = None,
                        suffix: str = "_z", digits: int | None = None) -> DataFrame:
    """SQL twin of the scaler: (x - mean) / sample sd, means and sds as scalar subqueries."""
    base = fit_on if fit_on is not None else df
    moments = base.agg(*[F.avg(c).alias(f"m_{c}") for c in feature_cols],
                       *[F.stddev_samp(c).alias(f"s_{c}") for c in feature_cols])
    out = []
    for c in feature_cols:
        sd = moments.select(f"s_{c}").scalar()
        # A constant feature scales to 0.0, as the MLlib scaler does.
        z = F.when(sd == 0, F.lit(0.0)).otherwise(F.try_divide(F.col(c) - moments.select(f"m_{c}").scalar(), sd))
        out.append((F.round(z, digits) if digits is not None else z).alias(f"{c}{suffix}"))
    return df.select("*", *out)


def scaling_effect(df: DataFrame, raw_cols: Sequence[str], scaled_cols: Sequence[str]) -> DataFrame:
    """M6: box statistics of chosen features before and after scaling (all rows)."""
    stats = profile.boxplot_stats(df, list(raw_cols) + list(scaled_cols))
    kind = F.when(F.col("measure").isin(list(scaled_cols)), F.lit("scaled")).otherwise(F.lit("raw"))
    return stats.withColumn("kind", kind)
