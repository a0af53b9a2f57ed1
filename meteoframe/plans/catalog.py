"""Named plans over the driver tables, each paired (where SQL can say it) with
its DuckDB twin. ``QUERIES[name](spark, sf_dir) -> DataFrame``; ``ORACLE[name]``
is SQL text over the pre-registered driver views.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteoframe.functions import columns as cols
from meteoframe.operators import evaluate as ev
from meteoframe.operators import features as feat
from meteoframe.operators import impute as imp
from meteoframe.operators import models as mdl
from meteoframe.operators import profile as prof
from meteoframe.operators import score as sc
from meteoframe.operators import series as ser
from meteoframe.plans import oracle as sql
from meteoframe.plans.stages import materialize
from meteoframe.sources import ingest
from meteoframe.sources.observations import MEASURES, observations, raw_text_observations, table_path
from meteoframe.spec import REFERENCE_SPEC

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Fixed parameters of the registered plans.
PICKED_DATE = "2001-02-14"   # the forecast day chosen on the scoring screen (in the test span)
CONTEXT_DAYS = 30            # +- days around it
TRAIN_RATIO = 0.8
BOUNDARY_ROWS = 100          # rows on each side of the train/test cut
RECENT_DATES = 50
HIST_BINS = 30
KDE_POINTS = 200
BOOTSTRAP_RUNS = 10


def register(name: str, oracle_sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle_sql is not None:
            ORACLE[name] = oracle_sql
        return fn
    return deco


# ----------------------------------------------------------------- shared stages

def features(spark: SparkSession, sf_dir: str, spec=REFERENCE_SPEC) -> DataFrame:
    """obs -> M2 (mean temperatures, zero rain) -> per-station lag/lead -> complete rows.

    The means are subqueries of the plan; the rows are shuffled once.
    """
    return ser.lag_lead_features(observations(spark, sf_dir), spec, prepare=imp.impute_mixed)


_STAGES: dict[tuple, DataFrame] = {}


def input_key(spark: SparkSession, sf_dir: str) -> tuple:
    """Session, folder, and size and time of the observation source: another input under the same path has another key."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, "orders"))
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return (spark.sparkContext.applicationId, sf_dir, fs.getContentSummary(p).getLength(), fs.getFileStatus(p).getModificationTime())


def split_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature table with the train/test tag.

    The feature table is written once per input; the split is a projection
    over it with the cut key as literals (found by a date histogram, no sort).
    Everything downstream (scaling, models, scoring, evaluation) reads this
    stage instead of re-deriving it.
    """
    key = (*input_key(spark, sf_dir), "split")
    if key not in _STAGES:
        feats = materialize(features(spark, sf_dir), "features")
        _STAGES[key] = ser.chronological_split(feats, TRAIN_RATIO)
    return _STAGES[key]


def boundary_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ser.split_boundary_slice(split_table(spark, sf_dir), BOUNDARY_ROWS)


# ----------------------------------------------------------------- sources / typing

@register("typed_observations", sql.with_obs(
    "raw as (select cast(obs_id as varchar) as obs_id, station, strftime(obs_date, '%Y-%m-%d') as obs_date, "
    + ", ".join(f"coalesce(cast({m} as varchar), 'NA') as {m}" for m in MEASURES) + " from obs)")
    + "select cast(obs_id as bigint) as obs_id, station, try_cast(obs_date as date) as obs_date, "
    + ", ".join(f"try_cast({m} as double) as {m}" for m in MEASURES) + " from raw")
def q_typed_observations(spark, sf_dir):
    raw = raw_text_observations(spark, sf_dir)
    typed = ingest.typed_observations(raw, date_cols=("obs_date",), numeric_cols=MEASURES)
    return typed.withColumn("obs_id", F.col("obs_id").cast("bigint"))


@register("national_daily", sql.with_obs()
          + "select obs_date, avg(min_temp) as min_temp, avg(max_temp) as max_temp, avg(rainfall) as rainfall, "
            "cast(count(*) as bigint) as n_obs from obs group by obs_date")
def q_national_daily(spark, sf_dir):
    return ser.national_daily(observations(spark, sf_dir))


# ----------------------------------------------------------------- impute

@register("impute_mean", sql.with_obs(sql.mean_clean_cte()) + "select * from mclean")
def q_impute_mean(spark, sf_dir):
    return imp.impute_mean(observations(spark, sf_dir), MEASURES)


@register("impute_mixed", sql.with_obs(sql.mixed_clean_cte()) + "select * from clean")
def q_impute_mixed(spark, sf_dir):
    return imp.impute_mixed(observations(spark, sf_dir))


@register("null_counts", sql.with_obs() + " union all ".join(
    f"select '{m}' as column_name, cast(count(*) filter (where {m} is null) as bigint) as null_count from obs"
    for m in MEASURES))
def q_null_counts(spark, sf_dir):
    return imp.null_counts(observations(spark, sf_dir), MEASURES)


@register("null_audit", sql.with_obs(sql.mixed_clean_cte()) + " union all ".join(
    f"select '{phase}' as phase, '{m}' as column_name, cast(count(*) filter (where {m} is null) as bigint) as null_count from {src}"
    for phase, src in (("before", "obs"), ("after", "clean")) for m in MEASURES))
def q_null_audit(spark, sf_dir):
    policy = {"min_temp": "mean", "max_temp": "mean", "rainfall": "zero"}
    return imp.null_audit_filled(observations(spark, sf_dir), policy)


# ----------------------------------------------------------------- series

@register("lag_lead_features", sql.with_obs(*sql.features_ctes()) + "select * from feat")
def q_lag_lead_features(spark, sf_dir):
    return features(spark, sf_dir)


@register("lag_lead_global", sql.with_obs(
    sql.mixed_clean_cte(), sql.lag_lead_cte("feat", "clean", REFERENCE_SPEC.with_(partition_by=())))
    + "select * from feat")
def q_lag_lead_global(spark, sf_dir):
    spec = REFERENCE_SPEC.with_(partition_by=())
    return ser.lag_lead_features(observations(spark, sf_dir), spec, prepare=imp.impute_mixed)


def _forward_sql() -> str:
    w = "over (partition by station order by obs_date, obs_id)"
    cols = [f"lead({m}, {i}) {w} as {m}_{i}" for i in range(1, 5) for m in MEASURES]
    cols += [f"lead({m}, {5 + j}) {w} as {m}_target_{j}" for j in range(2) for m in MEASURES]
    names = [f"{m}_{i}" for i in range(1, 5) for m in MEASURES] + [f"{m}_target_{j}" for j in range(2) for m in MEASURES]
    cond = " and ".join(f"{c} is not null" for c in ["obs_date", *MEASURES, *names])
    return (sql.with_obs(sql.mean_clean_cte())
            + f"select * from (select obs_id, station, obs_date, {', '.join(MEASURES)}, {', '.join(cols)} from mclean) where {cond}")


@register("forward_window_features", _forward_sql())
def q_forward_window_features(spark, sf_dir):
    return ser.forward_window_features(observations(spark, sf_dir),
                                       prepare=lambda d: imp.impute_mean(d, MEASURES))


@register("complete_cases", sql.with_obs()
          + "select * from obs where min_temp is not null and max_temp is not null and rainfall is not null")
def q_complete_cases(spark, sf_dir):
    return ser.complete_cases(observations(spark, sf_dir), MEASURES)


@register("global_row_index", sql.with_obs()
          + "select *, cast(row_number() over (order by obs_date, obs_id) as bigint) as row_idx from obs")
def q_global_row_index(spark, sf_dir):
    return ser.global_row_index(observations(spark, sf_dir))


@register("chronological_split", sql.with_obs(*sql.split_ctes(TRAIN_RATIO)) + "select * from split")
def q_chronological_split(spark, sf_dir):
    return split_table(spark, sf_dir)


@register("split_boundary_slice", sql.with_obs(*sql.boundary_ctes(BOUNDARY_ROWS)) + "select * from boundary")
def q_split_boundary_slice(spark, sf_dir):
    return boundary_slice(spark, sf_dir)


@register("split_position", sql.with_obs(*sql.boundary_ctes(BOUNDARY_ROWS))
          + "select cast(min(case when Type = 'Test' then pos end) as bigint) as split_pos, "
            "cast(count(*) as bigint) as n_rows from bpos")
def q_split_position(spark, sf_dir):
    return ser.split_position(boundary_slice(spark, sf_dir))


@register("axis_ticks", sql.with_obs(*sql.boundary_ctes(BOUNDARY_ROWS))
          + "select cast(t.tick as bigint) as tick, b.pos, b.obs_date, strftime(b.obs_date, '%d/%m/%Y') as label "
            "from (select range as tick from range(10)) t, (select count(*) as m from bpos) c, bpos b "
            "where b.pos = cast(floor(t.tick * (c.m - 1) / 9) as bigint)")
def q_axis_ticks(spark, sf_dir):
    return ser.axis_ticks(boundary_slice(spark, sf_dir))


@register("daily_mean_temp", sql.with_obs()
          + "select obs_date, avg((min_temp + max_temp) / 2.0) as mean_temp from obs group by obs_date")
def q_daily_mean_temp(spark, sf_dir):
    return ser.daily_mean_temp(observations(spark, sf_dir))


@register("recent_dates", sql.with_obs()
          + f"select distinct obs_date from obs order by obs_date desc limit {RECENT_DATES}")
def q_recent_dates(spark, sf_dir):
    return ser.recent_dates(observations(spark, sf_dir), RECENT_DATES)


@register("observation_on_date", sql.with_obs(*sql.split_ctes(TRAIN_RATIO))
          + f"select * from split where split = 'test' and obs_date = date '{PICKED_DATE}'")
def q_observation_on_date(spark, sf_dir):
    test = split_table(spark, sf_dir).filter(F.col("split") == "test")
    return ser.observation_on_date(test, PICKED_DATE)


@register("context_window", sql.with_obs()
          + f"select * from obs where obs_date between date '{PICKED_DATE}' - interval {CONTEXT_DAYS} day "
            f"and date '{PICKED_DATE}' + interval {CONTEXT_DAYS} day")
def q_context_window(spark, sf_dir):
    return ser.context_window(observations(spark, sf_dir), PICKED_DATE, CONTEXT_DAYS)


@register("one_row_per_date", sql.with_obs()
          + "select obs_id, station, obs_date, min_temp, max_temp, rainfall from "
            "(select *, row_number() over (partition by obs_date order by station, obs_id) as rn from obs) where rn = 1")
def q_one_row_per_date(spark, sf_dir):
    return ser.one_row_per_date(observations(spark, sf_dir))


# ----------------------------------------------------------------- profile

def _long_sql(src: str = "obs") -> str:
    return "long as (" + " union all ".join(
        f"select '{m}' as measure, {m} as value from {src} where {m} is not null" for m in MEASURES) + ")"


@register("table_shape", sql.with_obs() + "select cast(count(*) as bigint) as n_rows, cast(6 as bigint) as n_cols from obs")
def q_table_shape(spark, sf_dir):
    return prof.table_shape(observations(spark, sf_dir))


@register("describe_measures", sql.with_obs(_long_sql())
          + "select measure, cast(count(value) as bigint) as count, avg(value) as mean, round(stddev_samp(value), 6) as stddev, "
            "min(value) as min, max(value) as max from long group by measure")
def q_describe_measures(spark, sf_dir):
    return prof.describe_measures(observations(spark, sf_dir), MEASURES)


@register("exact_quantiles", sql.with_obs(_long_sql()) + " union all ".join(
    f"select measure, cast({p} as double) as p, quantile_cont(value, {p}) as quantile from long group by measure"
    for p in (0.25, 0.5, 0.75)))
def q_exact_quantiles(spark, sf_dir):
    return prof.exact_quantiles(observations(spark, sf_dir), MEASURES)


@register("approx_quantiles")
def q_approx_quantiles(spark, sf_dir):
    return prof.approx_quantiles(observations(spark, sf_dir), MEASURES, relative_error=0.01)


@register("advanced_statistics", sql.with_obs(_long_sql())
          + "select measure, cast(count(value) as bigint) as count, round(avg(value), 2) as mean, "
            "round(stddev_samp(value), 2) as stddev, round(var_samp(value), 2) as var, round(min(value), 2) as min, "
            "round(quantile_cont(value, 0.25), 2) as q1, round(quantile_cont(value, 0.5), 2) as median, "
            "round(quantile_cont(value, 0.75), 2) as q3, round(max(value), 2) as max, "
            "round(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 2) as iqr from long group by measure")
def q_advanced_statistics(spark, sf_dir):
    return prof.advanced_statistics(observations(spark, sf_dir), MEASURES, digits=2)


@register("advanced_statistics_sketch")
def q_advanced_statistics_sketch(spark, sf_dir):
    """A3 exactly as the original report: quartiles from the sketch (relative error 0.01)."""
    return prof.advanced_statistics(observations(spark, sf_dir), MEASURES, digits=2, exact=False)


_BOX_CTES = [
    _long_sql(),
    "q as (select measure, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as median, "
    "quantile_cont(value, 0.75) as q3 from long group by measure)",
    "f as (select measure, q1, median, q3, q3 - q1 as iqr, q1 - 1.5 * (q3 - q1) as lower_fence, "
    "q3 + 1.5 * (q3 - q1) as upper_fence from q)",
]


@register("boxplot_stats", sql.with_obs(*_BOX_CTES)
          + "select f.*, min(case when value between lower_fence and upper_fence then value end) as whisker_low, "
            "max(case when value between lower_fence and upper_fence then value end) as whisker_high, "
            "cast(sum(case when value between lower_fence and upper_fence then 0 else 1 end) as bigint) as n_outliers "
            "from f join long using (measure) group by all")
def q_boxplot_stats(spark, sf_dir):
    return prof.boxplot_stats(observations(spark, sf_dir), MEASURES)


def _long_keyed_sql() -> str:
    return "longk as (" + " union all ".join(
        f"select obs_id, station, obs_date, '{m}' as measure, {m} as value from obs where {m} is not null"
        for m in MEASURES) + ")"


@register("outlier_rows", sql.with_obs(*_BOX_CTES, _long_keyed_sql())
          + "select l.measure, l.obs_id, l.station, l.obs_date, l.value, f.lower_fence, f.upper_fence "
            "from longk l join f using (measure) where l.value < f.lower_fence or l.value > f.upper_fence")
def q_outlier_rows(spark, sf_dir):
    return prof.outlier_rows(observations(spark, sf_dir), MEASURES, keep=("obs_id", "station", "obs_date"))


@register("histogram30", sql.with_obs(
    _long_sql(),
    "rng as (select measure, min(value) as lo, max(value) as hi from long group by measure)",
    f"cnt as (select l.measure, cast(case when hi = lo then 0 else least(floor((value - lo) / ((hi - lo) / {float(HIST_BINS)})), {HIST_BINS - 1}) end as bigint) as bin, "
    "count(*) as c from long l join rng using (measure) group by all)",
    f"grid as (select measure, lo, hi, cast(b.range as bigint) as bin from rng, range({HIST_BINS}) b)")
    + f"select g.measure, g.bin, g.lo + g.bin * ((g.hi - g.lo) / {float(HIST_BINS)}) as bin_lo, "
      f"g.lo + (g.bin + 1) * ((g.hi - g.lo) / {float(HIST_BINS)}) as bin_hi, cast(coalesce(c, 0) as bigint) as count, "
      "round(log10(c), 6) as log10_count from grid g left join cnt using (measure, bin)")
def q_histogram30(spark, sf_dir):
    return prof.histogram(observations(spark, sf_dir), MEASURES, HIST_BINS)


@register("kde_curve", sql.with_obs(
    _long_sql(),
    "vc as (select measure, value, count(*) as w from long group by all)",
    "st as (select measure, count(*) as n, min(value) as lo, max(value) as hi, stddev_samp(value) as sd from long group by measure)",
    f"st2 as (select *, sd * pow(cast(n as double), -0.2) as bw, (hi - lo) / {float(KDE_POINTS - 1)} as step from st)",
    f"g as (select measure, cast(range as bigint) as point from st2, range({KDE_POINTS}))")
    + "select g.measure, g.point, s.lo + g.point * s.step as x, "
      "round(sum(v.w * exp(-0.5 * ((s.lo + g.point * s.step - v.value) / s.bw) * ((s.lo + g.point * s.step - v.value) / s.bw))) "
      "/ (s.n * s.bw * sqrt(2 * pi())), 6) as density "
      "from g join st2 s using (measure) join vc v using (measure) group by g.measure, g.point, s.lo, s.step, s.n, s.bw")
def q_kde_curve(spark, sf_dir):
    return prof.kde_curve(observations(spark, sf_dir), MEASURES, KDE_POINTS)


@register("correlation_matrix", sql.with_obs() + " union all ".join(
    f"select '{a}' as var_a, '{b}' as var_b, round(corr({a}, {b}), 6) as corr from obs" for a in MEASURES for b in MEASURES))
def q_correlation_matrix(spark, sf_dir):
    return prof.correlation_matrix(observations(spark, sf_dir), MEASURES)


# Descriptions of the typed observation columns.
OBS_DESCRIPTIONS = {
    "obs_id": "Observation key",
    "station": "Observing station",
    "obs_date": "Observation date",
    "min_temp": "Lowest temperature of the day (deg C)",
    "max_temp": "Highest temperature of the day (deg C)",
    "rainfall": "Rain over the day (mm)",
}
DEFAULT_DESCRIPTION = "Other averaged measure"


# DuckDB type names -> Spark simpleString names.
_SPARK_TYPE_NAMES = {"BIGINT": "bigint", "VARCHAR": "string", "DATE": "date", "DOUBLE": "double"}


def _spark_type_sql(col: str = "column_type") -> str:
    arms = " ".join(f"when '{k}' then '{v}'" for k, v in _SPARK_TYPE_NAMES.items())
    return f"case {col} {arms} end"


def _counts_sql(src: str) -> str:
    return " union all ".join(f"select '{c}' as column_name, count(*) as n_rows, count({c}) as n_values from {src}" for c in OBS_DESCRIPTIONS)


def _dictionary_sql() -> str:
    raw = ("raw as (select cast(obs_id as varchar) as obs_id, station, strftime(obs_date, '%Y-%m-%d') as obs_date, "
           + ", ".join(f"coalesce(cast({m} as varchar), 'NA') as {m}" for m in MEASURES) + " from obs)")
    typed = ("typed as (select obs_id, station, try_cast(obs_date as date) as obs_date, "
             + ", ".join(f"try_cast({m} as double) as {m}" for m in MEASURES) + " from raw)")
    descr = ", ".join(f"('{k}', '{v}')" for k, v in OBS_DESCRIPTIONS.items())
    return (sql.with_obs(raw, typed)
            + f"select column_name, {_spark_type_sql()} as data_type, "
              f"coalesce(d.descr, '{DEFAULT_DESCRIPTION}') as description, n_rows, n_values "
              f"from (describe select * from typed) join ({_counts_sql('typed')}) using (column_name) "
              f"left join (values {descr}) d(column_name, descr) using (column_name)")


@register("data_dictionary", _dictionary_sql())
def q_data_dictionary(spark, sf_dir):
    typed = ingest.typed_observations(raw_text_observations(spark, sf_dir), ("obs_date",), MEASURES)
    return prof.data_dictionary(typed, OBS_DESCRIPTIONS, DEFAULT_DESCRIPTION).join(prof.column_counts(typed), "column_name")


# ----------------------------------------------------------------- features and scaling

SPEC = REFERENCE_SPEC
FEATURES = SPEC.feature_cols
TARGETS = SPEC.target_cols
DAY1 = [SPEC.target_col(m, 1) for m in SPEC.measures]
# Display names of the day-1 predictions on the context chart.
PRED_NAMES = {SPEC.target_col("min_temp", 1): "Pred_Min", SPEC.target_col("max_temp", 1): "Pred_Max",
              SPEC.target_col("rainfall", 1): "Pred_Rain"}


def _train_test(spark, sf_dir):
    s = split_table(spark, sf_dir)
    return s, s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test")


@register("standardized_features", sql.with_obs(*sql.split_ctes(TRAIN_RATIO),
          "mom as (select " + ", ".join(f"avg({c}) as m_{c}, stddev_samp({c}) as s_{c}" for c in FEATURES)
          + " from split where split = 'train')")
          + "select obs_id, split, " + ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) as {c}_z" for c in FEATURES)
          + " from split, mom")
def q_standardized_features(spark, sf_dir):
    s, train, _ = _train_test(spark, sf_dir)
    scaling = feat.fit_scaling(train, FEATURES)
    scaled = scaling.transform(s.select("obs_id", "split", *FEATURES))
    return feat.scaled_columns(scaled, FEATURES, digits=6).drop(*FEATURES)


_EFFECT = [FEATURES[0], FEATURES[2]]


@register("scaling_effect", sql.with_obs(*sql.split_ctes(TRAIN_RATIO),
          "mom as (select " + ", ".join(f"avg({c}) as m_{c}, stddev_samp({c}) as s_{c}" for c in _EFFECT)
          + " from split where split = 'train')",
          "z as (select " + ", ".join(f"{c}, round(({c} - m_{c}) / s_{c}, 6) as {c}_z" for c in _EFFECT) + " from split, mom)",
          "long as (" + " union all ".join(f"select '{c}' as measure, {c} as value from z" for c in _EFFECT + [f"{c}_z" for c in _EFFECT]) + ")",
          "q as (select measure, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as median, "
          "quantile_cont(value, 0.75) as q3 from long group by measure)",
          "f as (select measure, q1, median, q3, q3 - q1 as iqr, q1 - 1.5 * (q3 - q1) as lower_fence, "
          "q3 + 1.5 * (q3 - q1) as upper_fence from q)",
          "b as (select f.*, min(case when value between lower_fence and upper_fence then value end) as whisker_low, "
          "max(case when value between lower_fence and upper_fence then value end) as whisker_high, "
          "cast(sum(case when value between lower_fence and upper_fence then 0 else 1 end) as bigint) as n_outliers "
          "from f join long using (measure) group by all)")
          + "select measure, " + ", ".join(f"round({c}, 6) as {c}" for c in
                                          ("q1", "median", "q3", "iqr", "lower_fence", "upper_fence", "whisker_low", "whisker_high"))
          + ", n_outliers, case when measure like '%\\_z' escape '\\' then 'scaled' else 'raw' end as kind from b")
def q_scaling_effect(spark, sf_dir):
    s, train, _ = _train_test(spark, sf_dir)
    z = feat.standardize_columns(s.select(*_EFFECT), _EFFECT, fit_on=train.select(*_EFFECT), digits=6)
    eff = feat.scaling_effect(z, _EFFECT, [f"{c}_z" for c in _EFFECT])
    r = ("q1", "median", "q3", "iqr", "lower_fence", "upper_fence", "whisker_low", "whisker_high")
    return eff.select("measure", *[F.round(c, 6).alias(c) for c in r], "n_outliers", "kind")


@register("ridge_one_lag", sql.with_obs(*sql.split_ctes(TRAIN_RATIO),
          "st as (select count(*) as n, avg(min_temp) as mx, avg(Target_min_temp_D1) as my, stddev_pop(min_temp) as sx, "
          "stddev_pop(Target_min_temp_D1) as sy, corr(min_temp, Target_min_temp_D1) as r from split where split = 'train')")
          + "select cast(n as bigint) as n, round(r / (1.0 + 0.1 / sy) * sy / sx, 6) as slope, "
            "round(my - (r / (1.0 + 0.1 / sy) * sy / sx) * mx, 6) as intercept from st")
def q_ridge_one_lag(spark, sf_dir):
    _, train, _ = _train_test(spark, sf_dir)
    fit = mdl.ridge_one_lag_closed_form(train, "min_temp", SPEC.target_col("min_temp", 1), 0.1)
    return fit.select("n", F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


# ----------------------------------------------------------------- evaluation on the persistence predictor

def _last_test(spark, sf_dir):
    _, _, test = _train_test(spark, sf_dir)
    return ev.persistence_predictions(test, SPEC)


def _sq(t: str, m: str) -> str:
    return f"({m} - {t}) * ({m} - {t})"


def _target_measure(t: str) -> str:
    return t[len("Target_"):t.rindex("_D")]


@register("rmse_by_target", sql.with_obs(*sql.split_ctes(TRAIN_RATIO)) + " union all ".join(
    f"select 'LAST' as algo, '{t}' as target, round(sqrt(avg({_sq(t, _target_measure(t))})), 6) as rmse "
    f"from split where split = 'test'" for t in TARGETS))
def q_rmse_by_target(spark, sf_dir):
    return ev.rmse_table(_last_test(spark, sf_dir), ["LAST"], TARGETS)


@register("persistence_rmse", sql.with_obs(*sql.split_ctes(TRAIN_RATIO)) + " union all ".join(
    f"select split, '{t}' as target, round(sqrt(avg({_sq(t, _target_measure(t))})), 6) as rmse "
    f"from split group by split" for t in TARGETS))
def q_persistence_rmse(spark, sf_dir):
    s = ev.persistence_predictions(split_table(spark, sf_dir), SPEC)
    aggs = [F.round(F.sqrt(F.avg((F.col(t) - F.col(_target_measure(t))) ** 2)), 6).alias(t) for t in TARGETS]
    return s.groupBy("split").agg(*aggs).unpivot(["split"], TARGETS, "target", "rmse")


def _boot_sql_cte(runs: int = BOOTSTRAP_RUNS) -> str:
    w = sql.bootstrap_weight_sql("obs_id", "(42 + r.range)")
    sums = ", ".join(f"sum(w * {_sq(t, _target_measure(t))}) as s_{i}" for i, t in enumerate(TARGETS))
    return (f"bw as (select cast(r.range as bigint) as run, t.*, {w} as w "
            f"from (select * from split where split = 'test') t, range(1, {runs + 1}) r), "
            f"bs as (select run, sum(w) as sw, {sums} from bw group by run), "
            "boot as (" + " union all ".join(
                f"select run, 'LAST' as algo, '{t}' as target, sqrt(s_{i} / sw) as rmse from bs"
                for i, t in enumerate(TARGETS)) + ")")


@register("bootstrap_rmse", sql.with_obs(*sql.split_ctes(TRAIN_RATIO), _boot_sql_cte())
          + "select run, algo, target, round(rmse, 6) as rmse from boot")
def q_bootstrap_rmse(spark, sf_dir):
    return ev.bootstrap_rmse(_last_test(spark, sf_dir), ["LAST"], TARGETS, BOOTSTRAP_RUNS)


@register("rmse_by_horizon", sql.with_obs(*sql.split_ctes(TRAIN_RATIO), _boot_sql_cte())
          + "select run, algo, 'D' || substr(target, length(target)) as horizon, round(avg(round(rmse, 6)), 6) as avg_rmse "
            "from boot group by all")
def q_rmse_by_horizon(spark, sf_dir):
    return ev.rmse_by_horizon(ev.bootstrap_rmse(_last_test(spark, sf_dir), ["LAST"], TARGETS, BOOTSTRAP_RUNS))


def _report_sql() -> str:
    avg_cols = [f"LAST_Avg_Day{d}" for d in (1, 2)]
    rmse_cols = [f"RMSE_LAST_{t}" for t in TARGETS]
    per_run = ("wide as (select run, "
               + ", ".join(f"avg(case when target like '%D{d}' then rmse end) as LAST_Avg_Day{d}" for d in (1, 2)) + ", "
               + ", ".join(f"max(case when target = '{t}' then rmse end) as RMSE_LAST_{t}" for t in TARGETS)
               + " from (select run, algo, target, round(rmse, 6) as rmse from boot) group by run)")
    cols = avg_cols + rmse_cols
    return (sql.with_obs(*sql.split_ctes(TRAIN_RATIO), _boot_sql_cte(), per_run)
            + "select case when grouping(run) = 1 then 'FINAL_AVERAGE' else cast(run as varchar) end as Run_ID, "
            + ", ".join(f"round(avg({c}), 6) as {c}" for c in cols)
            + " from wide group by grouping sets ((run), ())")


@register("bootstrap_report", _report_sql())
def q_bootstrap_report(spark, sf_dir):
    boot = ev.bootstrap_rmse(_last_test(spark, sf_dir), ["LAST"], TARGETS, BOOTSTRAP_RUNS)
    return ev.bootstrap_report(boot, ["LAST"], TARGETS, SPEC.leads)


@register("prediction_delta", sql.with_obs(*sql.split_ctes(TRAIN_RATIO)) + " union all ".join(
    f"select obs_id, obs_date, 'LAST' as algo, '{t}' as target, {_target_measure(t)} as prediction, {t} as actual, "
    f"{_target_measure(t)} - {t} as delta from split where split = 'test'" for t in TARGETS))
def q_prediction_delta(spark, sf_dir):
    return ev.prediction_delta(_last_test(spark, sf_dir), ["LAST"], TARGETS)


@register("rain_advice", sql.with_obs(*sql.split_ctes(TRAIN_RATIO))
          + "select obs_id, obs_date, rainfall as prediction, case when rainfall > 5.0 then 'heavy' "
            "when rainfall > 0.5 then 'light' when rainfall is not null then 'dry' end as advice "
            "from split where split = 'test'")
def q_rain_advice(spark, sf_dir):
    last = _last_test(spark, sf_dir)
    p = F.col(ev.pred_col("LAST", SPEC.target_col("rainfall", 1)))
    return last.select("obs_id", "obs_date", p.alias("prediction"), cols.rain_advice(p).alias("advice"))


def _context_rows(spark, sf_dir):
    """Test rows within +-CONTEXT_DAYS of the picked day, one representative per date."""
    _, _, test = _train_test(spark, sf_dir)
    ctx = ser.context_window(test.drop("split"), PICKED_DATE, CONTEXT_DAYS)
    return ser.one_row_per_date(ctx)


@register("actual_vs_predicted", sql.with_obs(*sql.split_ctes(TRAIN_RATIO))
          + "select obs_date, Target_rainfall_D1, Target_max_temp_D1, Target_min_temp_D1, "
            "min_temp as Pred_Min, max_temp as Pred_Max, rainfall as Pred_Rain from ("
            "select *, row_number() over (partition by obs_date order by station, obs_id) as rn from split "
            f"where split = 'test' and obs_date between date '{PICKED_DATE}' - interval {CONTEXT_DAYS} day "
            f"and date '{PICKED_DATE}' + interval {CONTEXT_DAYS} day) where rn = 1")
def q_actual_vs_predicted(spark, sf_dir):
    scored = ev.persistence_predictions(_context_rows(spark, sf_dir), SPEC)
    return sc.actual_vs_predicted(scored, "LAST", DAY1, PRED_NAMES)


# ----------------------------------------------------------------- models (rows-only checks)

_MODEL_CACHE: dict[tuple, dict] = {}


def cached_models(spark, sf_dir, name: str, made: Callable[[], dict]) -> dict:
    """What ``made()`` gave for this session, input and name; made at the first call."""
    key = (*input_key(spark, sf_dir), name)
    if key not in _MODEL_CACHE:
        _MODEL_CACHE[key] = made()
    return _MODEL_CACHE[key]


def trained_models(spark, sf_dir, algos=mdl.ALGOS):
    """Fit (once per session, input and algorithm) the per-target regressors on the training rows."""
    held = input_key(spark, sf_dir)
    todo = [a for a in algos if (*held, a) not in _MODEL_CACHE]
    if todo:
        _, train, _ = _train_test(spark, sf_dir)
        fitted = mdl.train_models(train, FEATURES, TARGETS, todo)
        for a in todo:
            _MODEL_CACHE[(*held, a)] = {k: m for k, m in fitted.items() if k.startswith(f"{a}_")}
    out = {}
    for a in algos:
        out.update(_MODEL_CACHE[(*held, a)])
    return out


@register("train_lr")
def q_train_lr(spark, sf_dir):
    return mdl.model_summary(spark, trained_models(spark, sf_dir, ("LR",)), FEATURES)


@register("train_rf")
def q_train_rf(spark, sf_dir):
    return mdl.model_summary(spark, trained_models(spark, sf_dir, ("RF",)), FEATURES)


@register("score_table")
def q_score_table(spark, sf_dir):
    _, _, test = _train_test(spark, sf_dir)
    return sc.score_all(test, trained_models(spark, sf_dir))


@register("forecast_card")
def q_forecast_card(spark, sf_dir):
    _, _, test = _train_test(spark, sf_dir)
    day = ser.one_row_per_date(ser.observation_on_date(test.drop("split"), PICKED_DATE))
    scored = sc.score_all(day, trained_models(spark, sf_dir))
    ctx = [SPEC.lag_col(m, 1) for m in SPEC.measures]
    return sc.forecast_card(scored, mdl.ALGOS, TARGETS, context_cols=ctx)


@register("forecast_context")
def q_forecast_context(spark, sf_dir):
    models = {k: v for k, v in trained_models(spark, sf_dir).items() if k.startswith("RF_")}
    scored = sc.score_all(_context_rows(spark, sf_dir), models)
    return sc.actual_vs_predicted(scored, "RF", DAY1, PRED_NAMES)


@register("boundary_forecast")
def q_boundary_forecast(spark, sf_dir):
    models = trained_models(spark, sf_dir)
    pos = ser.slice_positions(boundary_slice(spark, sf_dir))
    scored = sc.score_all(pos, models)
    return scored.select("pos", "obs_date", cols.day_label("obs_date").alias("label"), "Type", *TARGETS,
                         *[ev.pred_col(a, t) for a in mdl.ALGOS for t in TARGETS])


@register("model_bootstrap_report")
def q_model_bootstrap_report(spark, sf_dir):
    _, _, test = _train_test(spark, sf_dir)
    scored = sc.score_all(test, trained_models(spark, sf_dir))
    boot = ev.bootstrap_rmse(scored, mdl.ALGOS, TARGETS, BOOTSTRAP_RUNS)
    return ev.bootstrap_report(boot, mdl.ALGOS, TARGETS, SPEC.leads)


# ----------------------------------------------------------------- display and report layouts

FIRST_ROWS = 5


@register("first_feature_rows", sql.with_obs(*sql.features_ctes())
          + f"select * from feat order by obs_date, obs_id limit {FIRST_ROWS}")
def q_first_feature_rows(spark, sf_dir):
    return ser.first_rows(features(spark, sf_dir), FIRST_ROWS, ("obs_date", "obs_id"))


def _statistics_report_sql() -> str:
    stats = ("stats as (select measure, cast(count(value) as double) as count, round(avg(value), 2) as mean, "
             "round(stddev_samp(value), 2) as stddev, round(var_samp(value), 2) as var, round(min(value), 2) as min, "
             "round(quantile_cont(value, 0.25), 2) as q1, round(quantile_cont(value, 0.5), 2) as median, "
             "round(quantile_cont(value, 0.75), 2) as q3, round(max(value), 2) as max, "
             "round(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 2) as iqr from long group by measure)")
    rows = " union all ".join(
        f"select '{s}' as statistic, " + ", ".join(
            f"max(case when measure = '{m}' then {s} end) as {m}" for m in MEASURES) + " from stats"
        for s in prof.STAT_ROWS)
    return sql.with_obs(_long_sql(), stats) + rows


@register("statistics_report", _statistics_report_sql())
def q_statistics_report(spark, sf_dir):
    stats = prof.advanced_statistics(observations(spark, sf_dir), MEASURES, digits=2)
    return prof.statistics_by_row(stats, MEASURES)


@register("schema_rows", sql.with_obs()
          + f"select column_name, {_spark_type_sql()} as data_type, "
            f"\"null\" = 'YES' as nullable, n_rows, n_values from (describe select * from obs) join ({_counts_sql('obs')}) using (column_name)")
def q_schema_rows(spark, sf_dir):
    obs = observations(spark, sf_dir)
    return ingest.schema_rows(obs).join(prof.column_counts(obs), "column_name")


# ----------------------------------------------------------------- national series (S5 + W3)

NATIONAL_SPEC = REFERENCE_SPEC.with_(partition_by=(), order_by=("obs_date",), tie_break=())


def _national_sql() -> str:
    w = "over (order by obs_date)"
    lags = [f"lag({m}, {i}) {w} as {m}_L{i}" for i in range(1, 6) for m in MEASURES]
    leads = [f"lead({m}, {d}) {w} as Target_{m}_D{d}" for d in (1, 2) for m in MEASURES]
    names = [f"{m}_L{i}" for i in range(1, 6) for m in MEASURES] + [f"Target_{m}_D{d}" for d in (1, 2) for m in MEASURES]
    cond = " and ".join(f"{c} is not null" for c in ["obs_date", *MEASURES, *names])
    return (sql.with_obs("nat as (select obs_date, avg(min_temp) as min_temp, avg(max_temp) as max_temp, "
                         "avg(rainfall) as rainfall from obs group by obs_date)")
            + f"select * from (select obs_date, {', '.join(MEASURES)}, {', '.join(lags + leads)} from nat) where {cond}")


@register("national_lag_features", _national_sql())
def q_national_lag_features(spark, sf_dir):
    daily = ser.national_daily(observations(spark, sf_dir)).drop("n_obs")
    return ser.lag_lead_features(daily, NATIONAL_SPEC)


from meteoframe.plans import checked, stored  # noqa: E402,F401 - register their plans, which use the stages above
