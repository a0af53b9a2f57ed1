"""Regressors per target: ridge and random forest.

Training follows the reference set-up (assembler -> standard scaler ->
regressor, one model per algorithm and target) but fits the assembler and
scaler once, persists the scaled training vectors, and fits the twelve
regressors concurrently from a thread pool (Spark schedules the jobs side by
side; each fit is itself distributed). Every stored model is a complete
``PipelineModel([assembler, scaler, regressor])``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from threading import Semaphore

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteoframe.functions.columns import pearson
from meteoframe.operators import forest
from meteoframe.operators.features import VECTOR, fit_scaling

# Hyper-parameters of the two regressors.
LR_PARAMS = dict(regParam=0.1, elasticNetParam=0.0, maxIter=100, tol=1e-6, standardization=True)
RF_PARAMS = dict(numTrees=100, maxDepth=5, maxBins=32, seed=42, featureSubsetStrategy="auto",
                 subsamplingRate=1.0, minInstancesPerNode=1)
ALGOS = ("LR", "RF")


def make_regressor(algo: str, label: str, prediction_col: str = "prediction", params: Mapping[str, object] | None = None):
    """A regressor with the fixed hyper-parameters, those in ``params`` excepted."""
    if algo == "LR":
        return LinearRegression(featuresCol=VECTOR, labelCol=label, predictionCol=prediction_col, **{**LR_PARAMS, **(params or {})})
    if algo == "RF":
        forest = RandomForestRegressor(featuresCol=VECTOR, labelCol=label, predictionCol=prediction_col)
        return forest._set(**{**RF_PARAMS, **(params or {})})
    raise ValueError(f"unknown algorithm {algo!r}")


def model_key(algo: str, target: str) -> str:
    return f"{algo}_{target}"


#: Rows a partition of the training table holds up to MANY partitions, and beyond.
FEW_ROWS, MANY, MANY_ROWS = 1 << 14, 256, 1 << 20


def training_partitions(rows: int) -> int:
    """Partitions of the training table, from its rows alone: 16,384 rows each up to 256, then one more for each 1,048,576 rows."""
    few = min(rows, FEW_ROWS * MANY)
    return max(1, -(-few // FEW_ROWS)) + -(-(rows - few) // MANY_ROWS)


#: Rows that forests fitted side by side hold together: each keeps bins and 100 draws of every row, about 560 bytes.
FOREST_ROWS = 1 << 21


def forest_execution(rows: int) -> dict[str, object]:
    """Execution-only settings of a forest over ``rows`` rows (same trees).

    Each row's current node per tree is kept, in another 410 bytes a row and
    twice that between two levels, up to ``FOREST_ROWS`` rows; over more rows
    every tree is walked again from its root at each level.
    """
    return dict(cacheNodeIds=rows <= FOREST_ROWS)


def forests_at_once(rows: int, most: int = 3) -> int:
    """Forests fitted side by side, from the rows alone: up to ``most``, together over ``FOREST_ROWS`` rows, one at least."""
    return max(1, min(most, FOREST_ROWS // max(1, rows)))


#: Training rows beyond which the forests of all targets are grown together on packed rows (:mod:`forest`).
PACKED_ROWS = 1 << 20


def train_models(train: DataFrame, feature_cols: Sequence[str], targets: Sequence[str],
                 algos: Sequence[str] = ALGOS, parallelism: int | None = None, key_cols: Sequence[str] = ("obs_id",),
                 num_partitions: int | None = None, forest_parallelism: int = 3,
                 params: Mapping[str, Mapping[str, object]] | None = None) -> dict[str, PipelineModel]:
    """M9: fit the scaling once and every (algo, target) regressor on the scaled rows.

    The scaled rows are hash-partitioned on ``key_cols`` and sorted inside
    each partition before they are persisted: forest bagging draws per
    partition and row position, so a fixed layout makes the forests
    repeatable for the same input whatever its upstream partitioning. The
    partition count (:func:`training_partitions`) depends on the rows alone, not
    on the fits of this call or on a session setting. Fits run side by side, of
    forests at most ``forest_parallelism`` at a time and one alone over many rows
    (:func:`forests_at_once`), since each holds a draw for every row and tree. The
    scaled rows stay on disk, so that memory is left to the forest. ``params``
    sets hyper-parameters by algorithm. Over ``PACKED_ROWS`` rows with a key the
    forests of all targets are grown together (:func:`forest.fit_forests`) once
    the other fits are done: the same method and settings, other draws.
    """
    scaling = fit_scaling(train, feature_cols)
    rows = train.count()
    n = num_partitions or training_partitions(rows)
    keys = [k for k in key_cols if k in train.columns]
    cols = [VECTOR, *targets]
    scaled = vectors = scaling.transform(train).select(*keys, *cols)
    settings = {**RF_PARAMS, **((params or {}).get("RF") or {})}
    packed = "RF" in algos and bool(keys) and rows > PACKED_ROWS and forest.can_fit(settings)
    if keys and not packed:
        vectors = vectors.repartition(n, *keys).sortWithinPartitions(*keys)
    vectors = vectors.select(*cols).persist(StorageLevel.DISK_ONLY)
    try:
        jobs, forests = [(a, t) for t in targets for a in algos if not (packed and a == "RF")], Semaphore(forests_at_once(rows, forest_parallelism))

        def fit(job):
            a, t = job
            regressor = make_regressor(a, t, params={**(forest_execution(rows) if a == "RF" else {}), **((params or {}).get(a) or {})})
            with forests if a == "RF" else nullcontext():
                return model_key(a, t), regressor.fit(vectors)

        workers = parallelism or min(len(jobs), 12)  # one thread per fit: Spark interleaves their tasks
        with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
            fitted = dict(pool.map(fit, jobs))
    finally:
        vectors.unpersist()
    if packed:
        grown = forest.fit_forests(scaled, rows, keys, targets, VECTOR, settings, lambda t: make_regressor("RF", t, params=(params or {}).get("RF")))
        fitted.update({model_key("RF", t): m for t, m in grown.items()})
    return {k: PipelineModel(stages=[*scaling.stages, m]) for k, m in fitted.items()}


def save_models(models: Mapping[str, PipelineModel], directory: str) -> None:
    """One folder per model key, overwritten."""
    for key, model in models.items():
        model.write().overwrite().save(f"{directory.rstrip('/')}/{key}")


def load_models(spark: SparkSession, directory: str, targets: Sequence[str],
                algos: Sequence[str] = ALGOS) -> tuple[dict[str, PipelineModel], list[str]]:
    """Load what loads; return (models, missing keys). Fails if the folder is absent."""
    from meteoframe.sources.ingest import path_exists

    if not path_exists(spark, directory):
        raise FileNotFoundError(directory)
    models, missing = {}, []
    for a in algos:
        for t in targets:
            key = model_key(a, t)
            try:
                models[key] = PipelineModel.load(f"{directory.rstrip('/')}/{key}")
            except Exception:  # noqa: BLE001 - a broken folder is reported, not fatal
                missing.append(key)
    return models, missing


def regressor_of(model: PipelineModel):
    return model.stages[-1]


def model_summary(spark: SparkSession, models: Mapping[str, PipelineModel], feature_cols: Sequence[str]) -> DataFrame:
    """M7/M8 output: (model, algo, target, term, value) — LR coefficients and
    intercept, RF feature importances and tree count. Bounded by models x features."""
    rows = []
    for key, pm in models.items():
        algo, target = key.split("_", 1)
        reg = regressor_of(pm)
        if algo == "LR":
            for name, v in zip(feature_cols, reg.coefficients.toArray()):
                rows.append((key, algo, target, f"coef:{name}", float(v)))
            rows.append((key, algo, target, "intercept", float(reg.intercept)))
        else:
            for name, v in zip(feature_cols, reg.featureImportances.toArray()):
                rows.append((key, algo, target, f"importance:{name}", float(v)))
            rows.append((key, algo, target, "trees", float(reg.getNumTrees)))
    return spark.createDataFrame(rows, "model string, algo string, target string, term string, value double")


def ridge_one_lag_closed_form(df: DataFrame, x: str, y: str, reg_param: float = 0.1) -> DataFrame:
    """The one-feature ridge fit of MLlib in closed form.

    With standardised feature and label (population sd), the normal-equation
    solver penalises the scaled slope with lambda / sd_y, so the scaled slope
    is r / (1 + lambda / sd_y); on the original scale
    b = r / (1 + lambda / sd_y) * sd_y / sd_x and a = mean_y - b * mean_x.
    """
    st = df.agg(F.avg(x).alias("mx"), F.avg(y).alias("my"), F.stddev_pop(x).alias("sx"),
                F.stddev_pop(y).alias("sy"), pearson(x, y).alias("r"), F.count(F.lit(1)).alias("n"))
    shrink = F.lit(1.0) + F.try_divide(F.lit(reg_param), F.col("sy"))
    slope = F.try_divide(F.col("r") * F.col("sy"), shrink * F.col("sx"))
    return st.select("n", slope.alias("slope"), (F.col("my") - slope * F.col("mx")).alias("intercept"))


def ridge_one_lag_mllib(df: DataFrame, x: str, y: str, reg_param: float = 0.1) -> tuple[float, float]:
    """The same fit through MLlib (for the equivalence test)."""
    from pyspark.ml.feature import VectorAssembler

    v = VectorAssembler(inputCols=[x], outputCol="fx").transform(df)
    m = LinearRegression(featuresCol="fx", labelCol=y, regParam=reg_param, elasticNetParam=0.0,
                         standardization=True, solver="normal").fit(v)
    return float(m.coefficients[0]), float(m.intercept)



def stump_of(model: PipelineModel, feature: int = 0) -> tuple[float, float, float]:
    """(split value, mean of the left leaf, mean of the right one) of a forest of one depth-1 tree; the split in the feature's own unit."""
    root = regressor_of(model).trees[0]._call_java("rootNode")
    scaler = model.stages[-2]
    value = root.split().threshold() * float(scaler.std[feature]) + (float(scaler.mean[feature]) if scaler.getWithMean() else 0.0)
    return value, root.leftChild().prediction(), root.rightChild().prediction()
