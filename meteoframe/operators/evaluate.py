"""Error metrics and bootstrap reports.

Predictions arrive as columns ``pred_{algo}__{target}`` next to the label
columns. Every metric over every (algo, target) pair is one aggregate; the
bootstrap draws Poisson(1) row weights from a hash of (row key, run), so ten
resamples cost one pass and are independent of partitioning and retries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteoframe.functions.columns import poisson1_weight, unit_hash, unit_hash52
from meteoframe.operators.ordering import with_row_index
from meteoframe.spec import REFERENCE_SPEC, FeatureSpec

FINAL_ROW = "FINAL_AVERAGE"


def pred_col(algo: str, target: str) -> str:
    return f"pred_{algo}__{target}"


def persistence_predictions(df: DataFrame, spec: FeatureSpec = REFERENCE_SPEC, algo: str = "LAST") -> DataFrame:
    """E5 predictor: tomorrow (and the day after) equals today."""
    preds = [F.col(m).alias(pred_col(algo, spec.target_col(m, d)))
             for d in range(1, spec.leads + 1) for m in spec.measures]
    return df.select("*", *preds)


def _sq_err(algo: str, target: str):
    e = F.col(pred_col(algo, target)) - F.col(target)
    return e * e


def rmse_table(scored: DataFrame, algos: Sequence[str], targets: Sequence[str], digits: int = 6) -> DataFrame:
    """(algo, target, rmse) for every pair, one aggregate."""
    aggs = [F.sqrt(F.avg(_sq_err(a, t))).alias(f"{a}|{t}") for a in algos for t in targets]
    wide = scored.agg(*aggs)
    long = wide.unpivot([], [f"{a}|{t}" for a in algos for t in targets], "key", "rmse")
    parts = F.split("key", r"\|")
    return long.select(parts[0].alias("algo"), parts[1].alias("target"), F.round("rmse", digits).alias("rmse"))


def bootstrap_rmse(scored: DataFrame, algos: Sequence[str], targets: Sequence[str], runs: int = 10,
                   key_col: str = "obs_id", seed: int = 42, digits: int | None = 6) -> DataFrame:
    """(run, algo, target, rmse) over ``runs`` bootstrap resamples.

    Run r weights each row by a Poisson(1) draw from ``md5(key-(seed+r))``;
    RMSE_r = sqrt(sum w*(y-p)^2 / sum w). Each row is repeated once per run
    inside the map task and folded straight into a partial aggregate keyed by
    run (a few sums per model), so the shuffle carries runs x tasks rows and
    the aggregate stays inside whole-stage codegen.
    """
    per_run = scored.select(
        *[F.col(c) for c in dict.fromkeys([key_col, *targets, *[pred_col(a, t) for a in algos for t in targets]])],
        F.explode(F.sequence(F.lit(1), F.lit(runs))).alias("run"))
    per_run = per_run.withColumn("w", poisson1_weight(unit_hash(F.col(key_col), F.col("run") + F.lit(seed))))
    aggs = [F.sum("w").alias("W")]
    aggs += [F.sum(F.col("w") * _sq_err(a, t)).alias(f"S|{a}|{t}") for a in algos for t in targets]
    wide = per_run.groupBy("run").agg(*aggs)
    cols = []
    for a in algos:
        for t in targets:
            v = F.sqrt(F.try_divide(F.col(f"`S|{a}|{t}`"), F.col("W")))
            cols.append(F.struct(F.lit(a).alias("algo"), F.lit(t).alias("target"),
                                 (F.round(v, digits) if digits is not None else v).alias("rmse")))
    return wide.select(F.col("run").cast("bigint").alias("run"), F.inline(F.array(*cols)))


def exact_resample(df: DataFrame, order_cols: Sequence[str], runs: int = 10, seed: int = 42, index_col: str = "row_idx") -> tuple[DataFrame, DataFrame]:
    """``runs`` resamples with replacement of exactly n of n rows: (rows with ``index_col``, draws).

    ``draws``: (run, ``index_col``, w), the rows drawn and how often; w adds up
    to n in every run. Draw number d of a run takes the row whose position is
    given by the first 52 bits of ``md5(d-(seed+run))``, so the counts are those
    of n independent uniform draws and depend on the order of the rows alone,
    not on their layout. Every row makes one draw a run, and equal draws meet
    in one shuffle of small rows.
    """
    indexed = with_row_index(df, order_cols, index_col)
    n = indexed.select(F.max(index_col)).scalar()
    each = indexed.select(F.col(index_col).alias("d")).withColumn("run", F.explode(F.sequence(F.lit(1), F.lit(runs))))
    u = unit_hash52(F.col("d") - 1, F.col("run") + F.lit(seed))
    at = F.least(F.floor(u * n.cast("double")).cast("bigint"), n - 1) + 1
    draws = each.select(F.col("run").cast("bigint").alias("run"), at.alias(index_col)).groupBy("run", index_col).agg(F.count(F.lit(1)).alias("w"))
    return indexed, draws


def exact_bootstrap_rmse(scored: DataFrame, algos: Sequence[str], targets: Sequence[str], order_cols: Sequence[str], runs: int = 10,
                         seed: int = 42, digits: int = 6) -> DataFrame:
    """(run, algo, target, n_drawn, rmse) over exact resamples: sqrt(sum w*(y-p)^2 / n)."""
    errors = {(a, t): f"_e{i}" for i, (a, t) in enumerate((a, t) for a in algos for t in targets)}
    rows, draws = exact_resample(scored.select(*order_cols, *[_sq_err(a, t).alias(e) for (a, t), e in errors.items()]), order_cols, runs, seed)
    sums = draws.join(rows, "row_idx").groupBy("run").agg(F.sum("w").alias("n_drawn"), *[F.sum(F.col("w") * F.col(e)).alias(e) for e in errors.values()])
    each = [F.struct(F.lit(a).alias("algo"), F.lit(t).alias("target"), F.round(F.sqrt(F.try_divide(F.col(e), F.col("n_drawn"))), digits).alias("rmse")) for (a, t), e in errors.items()]
    return sums.select("run", "n_drawn", F.inline(F.array(*each))).select("run", "algo", "target", "n_drawn", "rmse")


def horizon_of(target_col: str = "target"):
    """horizon label ('D1', 'D2', ...) parsed from the target name."""
    return F.concat(F.lit("D"), F.regexp_extract(F.col(target_col), r"_D(\d+)$", 1))


def rmse_by_horizon(rmse_long: DataFrame, digits: int = 6) -> DataFrame:
    """Mean RMSE of the measures per (run, algo, horizon)."""
    keys = [c for c in ("run",) if c in rmse_long.columns]
    return rmse_long.groupBy(*keys, "algo", horizon_of().alias("horizon")).agg(
        F.round(F.avg("rmse"), digits).alias("avg_rmse"))


def bootstrap_report(rmse_long: DataFrame, algos: Sequence[str], targets: Sequence[str], leads: int = 2,
                     digits: int = 6) -> DataFrame:
    """One row per run plus the FINAL_AVERAGE row.

    Columns: Run_ID, {algo}_Avg_Day{d} (d-major, algo-minor), then
    RMSE_{algo}_{target} in target order. The average row comes from a
    ROLLUP over the run key (grouping set ``()``).
    """
    avg_cols = [f"{a}_Avg_Day{d}" for d in range(1, leads + 1) for a in algos]
    rmse_cols = [f"RMSE_{a}_{t}" for t in targets for a in algos]
    day = F.regexp_extract(F.col("target"), r"_D(\d+)$", 1).cast("int")
    # One conditional aggregate per run gives every report column: the
    # bootstrap pass underneath runs once.
    per_run = [F.avg(F.when((F.col("algo") == a) & (day == d), F.col("rmse"))).alias(f"{a}_Avg_Day{d}")
               for d in range(1, leads + 1) for a in algos]
    per_run += [F.max(F.when((F.col("algo") == a) & (F.col("target") == t), F.col("rmse"))).alias(f"RMSE_{a}_{t}")
                for t in targets for a in algos]
    wide = rmse_long.groupBy("run").agg(*per_run)
    rolled = wide.rollup("run").agg(
        F.grouping("run").alias("_g"), *[F.avg(c).alias(c) for c in avg_cols + rmse_cols])
    run_id = F.when(F.col("_g") == 1, F.lit(FINAL_ROW)).otherwise(F.col("run").cast("string"))
    return rolled.select(run_id.alias("Run_ID"), *[F.round(c, digits).alias(c) for c in avg_cols + rmse_cols])


def prediction_delta(scored: DataFrame, algos: Sequence[str], targets: Sequence[str],
                     keep: Sequence[str] = ("obs_id", "obs_date")) -> DataFrame:
    """(keys, algo, target, prediction, actual, delta = prediction - actual), long form."""
    parts = [F.struct(F.lit(a).alias("algo"), F.lit(t).alias("target"),
                      F.col(pred_col(a, t)).alias("prediction"), F.col(t).alias("actual"))
             for a in algos for t in targets]
    long = scored.select(*keep, F.inline(F.array(*parts)))
    return long.withColumn("delta", F.col("prediction") - F.col("actual"))
