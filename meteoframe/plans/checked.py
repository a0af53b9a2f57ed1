"""Plans that run the shipped model, source and sketch code and still have a SQL twin.

One ridge pipeline on one feature has a closed form, so training, saving,
loading, scoring and the views on top of them are checked value by value.
Registered by ``catalog``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from meteoframe.operators import evaluate as ev
from meteoframe.operators import models as mdl
from meteoframe.operators import profile as prof
from meteoframe.operators import score as sc
from meteoframe.operators import series as ser
from meteoframe.plans import catalog as cat
from meteoframe.plans import oracle as sql
from meteoframe.session import ensure_checkpoint_dir
from meteoframe.sources import ingest
from meteoframe.sources.observations import MEASURES, observations, raw_text_observations

FEATURE, TARGET = "min_temp", "Target_min_temp_D1"
PRED = ev.pred_col("LR", TARGET)
RANK_ERROR = 0.01


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stages/{name}-{uuid.uuid4().hex}"


# ----------------------------------------------------------------- one-lag ridge through train, save, load, score

def one_lag_models(spark, sf_dir):
    """The one-feature ridge pipeline: fitted, saved and loaded again (once per session and input)."""
    def made():
        train = cat.split_table(spark, sf_dir).filter(F.col("split") == "train")
        path = _folder(spark, "one-lag-models")
        mdl.save_models(mdl.train_models(train, [FEATURE], [TARGET], ["LR"]), path)
        models, missing = mdl.load_models(spark, path, [TARGET], ["LR"])
        if missing:
            raise RuntimeError(f"models that did not load: {missing}")
        return models
    return cat.cached_models(spark, sf_dir, "one-lag", made)


def _scored(spark, sf_dir, rows):
    return sc.score_all(rows, one_lag_models(spark, sf_dir))


def _test(spark, sf_dir):
    return cat.split_table(spark, sf_dir).filter(F.col("split") == "test").drop("split")


_FIT = (f"st as (select avg({FEATURE}) as mx, avg({TARGET}) as my, stddev_pop({FEATURE}) as sx, stddev_pop({TARGET}) as sy, "
        f"corr({FEATURE}, {TARGET}) as r from split where split = 'train'), "
        "fit as (select r / (1.0 + 0.1 / sy) * sy / sx as slope, my - (r / (1.0 + 0.1 / sy) * sy / sx) * mx as intercept from st)")
_LINE = f"(intercept + slope * {FEATURE})"
_TEST_SQL = f"scored as (select split.* exclude (split), {_LINE} as p from split, fit where split = 'test')"


def _one_lag_sql(*more: str) -> str:
    return sql.with_obs(*sql.split_ctes(cat.TRAIN_RATIO), _FIT, _TEST_SQL, *more)


@cat.register("train_lr_one_lag", sql.with_obs(*sql.split_ctes(cat.TRAIN_RATIO), _FIT,
              f"sd as (select stddev_samp({FEATURE}) as s, avg({FEATURE}) as m from split where split = 'train')")
              + f"select 'LR_{TARGET}' as model, 'LR' as algo, '{TARGET}' as target, 'coef:{FEATURE}' as term, round(slope * s, 6) as value from fit, sd "
                f"union all select 'LR_{TARGET}', 'LR', '{TARGET}', 'intercept', round(intercept + slope * m, 6) from fit, sd")
def q_train_lr_one_lag(spark, sf_dir):
    """Coefficients are those of the centred and scaled feature."""
    got = mdl.model_summary(spark, one_lag_models(spark, sf_dir), [FEATURE])
    return got.withColumn("value", F.round("value", 6))


@cat.register("score_one_lag", _one_lag_sql() + "select obs_id, obs_date, round(p, 6) as prediction from scored")
def q_score_one_lag(spark, sf_dir):
    return _scored(spark, sf_dir, _test(spark, sf_dir)).select("obs_id", "obs_date", F.round(PRED, 6).alias("prediction"))


@cat.register("rmse_one_lag", _one_lag_sql()
              + f"select 'LR' as algo, '{TARGET}' as target, round(sqrt(avg((p - {TARGET}) * (p - {TARGET}))), 6) as rmse from scored")
def q_rmse_one_lag(spark, sf_dir):
    return ev.rmse_table(_scored(spark, sf_dir, _test(spark, sf_dir)), ["LR"], [TARGET])


@cat.register("card_one_lag", _one_lag_sql()
              + f"select obs_id, station, obs_date, {FEATURE}_L1, 'LR' as algo, '{TARGET}' as target, round(p, 6) as prediction, {TARGET} as actual, "
                f"round(p - {TARGET}, 6) as delta, cast(null as varchar) as advice, true as model_found from ("
                "select *, row_number() over (partition by obs_date order by station, obs_id) as rn from scored "
                f"where obs_date = date '{cat.PICKED_DATE}') where rn = 1")
def q_card_one_lag(spark, sf_dir):
    day = ser.one_row_per_date(ser.observation_on_date(_test(spark, sf_dir), cat.PICKED_DATE))
    card = sc.forecast_card(_scored(spark, sf_dir, day), ["LR"], [TARGET], context_cols=[f"{FEATURE}_L1"])
    return card.withColumn("prediction", F.round("prediction", 6)).withColumn("delta", F.round("delta", 6))


@cat.register("context_one_lag", _one_lag_sql()
              + f"select obs_date, {TARGET}, round(p, 6) as Pred_Min from ("
                "select *, row_number() over (partition by obs_date order by station, obs_id) as rn from scored where obs_date between "
                f"date '{cat.PICKED_DATE}' - interval {cat.CONTEXT_DAYS} day and date '{cat.PICKED_DATE}' + interval {cat.CONTEXT_DAYS} day) where rn = 1")
def q_context_one_lag(spark, sf_dir):
    rows = ser.one_row_per_date(ser.context_window(_test(spark, sf_dir), cat.PICKED_DATE, cat.CONTEXT_DAYS))
    shown = sc.actual_vs_predicted(_scored(spark, sf_dir, rows), "LR", [TARGET], {TARGET: "Pred_Min"})
    return shown.withColumn("Pred_Min", F.round("Pred_Min", 6))


@cat.register("boundary_one_lag", sql.with_obs(*sql.boundary_ctes(cat.BOUNDARY_ROWS), _FIT)
              + f"select pos, obs_date, Type, {TARGET}, round({_LINE}, 6) as prediction from bpos, fit")
def q_boundary_one_lag(spark, sf_dir):
    rows = ser.slice_positions(cat.boundary_slice(spark, sf_dir))
    return _scored(spark, sf_dir, rows).select("pos", "obs_date", "Type", TARGET, F.round(PRED, 6).alias("prediction"))


def _report_sql() -> str:
    w = sql.bootstrap_weight_sql("obs_id", "(42 + r.range)")
    runs = (f"bw as (select cast(r.range as bigint) as run, (p - {TARGET}) * (p - {TARGET}) as e, {w} as w "
            f"from scored, range(1, {cat.BOOTSTRAP_RUNS + 1}) r), "
            "boot as (select run, round(sqrt(sum(w * e) / sum(w)), 6) as rmse from bw group by run)")
    return (_one_lag_sql(runs) + "select case when grouping(run) = 1 then 'FINAL_AVERAGE' else cast(run as varchar) end as Run_ID, "
            f"round(avg(rmse), 6) as LR_Avg_Day1, round(avg(rmse), 6) as RMSE_LR_{TARGET} from boot group by grouping sets ((run), ())")


@cat.register("report_one_lag", _report_sql())
def q_report_one_lag(spark, sf_dir):
    boot = ev.bootstrap_rmse(_scored(spark, sf_dir, _test(spark, sf_dir)), ["LR"], [TARGET], cat.BOOTSTRAP_RUNS)
    return ev.bootstrap_report(boot, ["LR"], [TARGET], leads=1)


# ----------------------------------------------------------------- sources and sinks, there and back

@cat.register("csv_roundtrip", sql.with_obs() + "select * from obs")
def q_csv_roundtrip(spark, sf_dir):
    """Text observations written as CSV in another column order with a column more, read by header name and typed."""
    path = _folder(spark, "csv")
    raw = raw_text_observations(spark, sf_dir)
    raw.select(F.lit("x").alias("Remark"), *reversed(raw.columns)).write.option("header", True).csv(path)
    back = ingest.read_observations_csv(spark, path).select(*raw.columns)
    return ingest.typed_observations(back, ("obs_date",), MEASURES).withColumn("obs_id", F.col("obs_id").cast("bigint"))


@cat.register("parquet_roundtrip", sql.with_obs() + "select * from obs")
def q_parquet_roundtrip(spark, sf_dir):
    path = _folder(spark, "parquet") + "/obs.parquet"
    ingest.write_parquet(observations(spark, sf_dir), path)
    return ingest.load_table(spark, path)


# ----------------------------------------------------------------- sketch quantiles within their bound

@cat.register("approx_quantile_rank_error", " union all ".join(
    f"select '{m}' as measure, cast({p} as double) as p, true as within from (select count({c}) as n from orders) where n > 0"
    for m, c in zip(MEASURES, ("o_totalprice", "o_totalprice", "o_custkey")) for p in prof.QUARTILES))
def q_approx_quantile_rank_error(spark, sf_dir):
    """Whether each sketch quantile lies within the relative error by rank."""
    obs = observations(spark, sf_dir)
    got = prof.approx_quantiles(obs, MEASURES, relative_error=RANK_ERROR)  # measures x probabilities rows
    counts = prof.value_counts(obs, MEASURES).join(F.broadcast(got), "measure").groupBy("measure", "p").agg(
        F.sum("w").alias("n"), F.sum(F.when(F.col("value") < F.col("quantile"), F.col("w")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("value") <= F.col("quantile"), F.col("w")).otherwise(0)).alias("upto"))
    low, high = (F.col("p") - RANK_ERROR) * F.col("n") - 1, (F.col("p") + RANK_ERROR) * F.col("n") + 1
    return counts.select("measure", "p", ((F.col("below") <= high) & (F.col("upto") >= low)).alias("within"))
