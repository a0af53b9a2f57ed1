"""Scoring views over fitted models.

A fitted set of pipelines shares one assembler and scaler, so a table is
assembled and scaled once and every regressor then adds its own prediction
column; no per-model pass and no join of predictions back onto the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteoframe.functions.columns import rain_advice
from meteoframe.operators.evaluate import pred_col
from meteoframe.operators.features import RAW_VECTOR, VECTOR


def _prep_key(pm: PipelineModel) -> tuple:
    """Identity of a pipeline's fitted preparation (assembler inputs, scaler mean and sd)."""
    key = []
    for st in pm.stages[:-1]:
        if hasattr(st, "getInputCols"):
            key.append(("in", tuple(st.getInputCols())))
        if hasattr(st, "mean") and hasattr(st, "std"):
            key.append(("scale", tuple(st.mean.toArray()), tuple(st.std.toArray())))
    return tuple(key)


def score_all(df: DataFrame, models: Mapping[str, PipelineModel], keep_vectors: bool = False) -> DataFrame:
    """Add ``pred_{algo}__{target}`` for every model, in one map stage.

    Models that share a fitted preparation (as ``train_models`` builds them)
    assemble and scale once; each regressor then writes its own column.
    Pipelines loaded from elsewhere with a different preparation get their
    own (still no join, no extra pass: every step is a projection).
    """
    if not models:
        return df
    groups: dict[tuple, list[tuple[str, PipelineModel]]] = {}
    for key, pm in models.items():
        groups.setdefault(_prep_key(pm), []).append((key, pm))
    out = df
    for members in groups.values():
        out = PipelineModel(stages=members[0][1].stages[:-1]).transform(out)
        for key, pm in members:
            algo, target = key.split("_", 1)
            reg = pm.stages[-1].copy()
            reg.setPredictionCol(pred_col(algo, target))
            out = reg.transform(out)
        if not keep_vectors or len(groups) > 1:
            out = out.drop(VECTOR, RAW_VECTOR)
    return out


def with_missing_predictions(df: DataFrame, missing: Sequence[str], default: float | None = None) -> DataFrame:
    """A model that did not load gives a typed null (or ``default``) column, and a flag."""
    out = df
    for key in missing:
        algo, target = key.split("_", 1)
        out = out.withColumn(pred_col(algo, target), F.lit(default).cast("double"))
    return out


def forecast_card(scored: DataFrame, algos: Sequence[str], targets: Sequence[str], rain_measure: str = "rainfall",
                  context_cols: Sequence[str] = (), keys: Sequence[str] = ("obs_id", "station", "obs_date"),
                  missing: Sequence[str] = ()) -> DataFrame:
    """Per (date row, algo, target): prediction, actual, delta, rain advice, lag-1 context.

    ``model_found`` is false for the model keys in ``missing``, whatever default
    their prediction has, and for rows without a prediction.
    """
    parts = [F.struct(F.lit(a).alias("algo"), F.lit(t).alias("target"),
                      F.col(pred_col(a, t)).alias("prediction"), F.col(t).alias("actual"), F.lit(f"{a}_{t}" not in missing).alias("_loaded"))
             for a in algos for t in targets if pred_col(a, t) in scored.columns]
    long = scored.select(*keys, *context_cols, F.inline(F.array(*parts)))
    is_rain = F.col("target").contains(f"_{rain_measure}_")
    return long.select(
        "*", (F.col("prediction") - F.col("actual")).alias("delta"),
        F.when(is_rain, rain_advice("prediction")).alias("advice"),
        (F.col("_loaded") & F.col("prediction").isNotNull()).alias("model_found")).drop("_loaded")


def actual_vs_predicted(scored: DataFrame, algo: str, targets: Sequence[str],
                        names: Mapping[str, str], date_col: str = "obs_date") -> DataFrame:
    """Date, actual day-1 targets, then the predictions renamed for display.

    Column order follows the report: date, targets in reverse order, then predictions.
    """
    preds = [F.col(pred_col(algo, t)).alias(names[t]) for t in targets]
    return scored.select(date_col, *[F.col(t) for t in reversed(list(targets))], *preds)
