"""Plans over what was written: reports and ordered files read back, layouts, sketches, rejects, and the forest of one split.

Each writes its table below the checkpoint folder, reads it back through the
shipped readers and is compared with SQL over the driver's tables. Registered by
``catalog``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from meteoframe.operators import evaluate as ev
from meteoframe.operators import impute as imp
from meteoframe.operators import models as mdl
from meteoframe.operators import profile as prof
from meteoframe.operators import score as sc
from meteoframe.operators import sketches as sk
from meteoframe.plans import catalog as cat
from meteoframe.plans import oracle as sql
from meteoframe.plans.checked import _folder
from meteoframe.sources import ingest
from meteoframe.sources.observations import MEASURES, observations, raw_text_observations

STUMP_TARGET = "Target_min_temp_D1"
#: First and last date of the ranges asked of the stored sketches: a month, three years, all.
SKETCH_RANGES = (("month", "1997-03-01", "1997-03-31"), ("years", "1995-07-01", "1998-06-30"), ("all", "1900-01-01", "2099-12-31"))
RANK_ERROR = 0.01


# ----------------------------------------------------------------- A4: stored sketches

@cat.register("stored_sketch_quantiles", sql.with_obs(cat._long_keyed_sql()) + " union all ".join(
    f"select '{name}' as dates, measure, cast({p} as double) as p, cast(count(value) as bigint) as n, true as within from longk "
    f"where obs_date between date '{a}' and date '{b}' group by measure" for name, a, b in SKETCH_RANGES for p in prof.QUARTILES))
def q_stored_sketch_quantiles(spark, sf_dir):
    """Quantiles of three date ranges from one stored table of sketches; ``within``: the rows hold the value at that rank, give or take 1 %."""
    obs = observations(spark, sf_dir)
    path = _folder(spark, "sketches")
    ingest.write_parquet(sk.daily_sketches(obs, MEASURES), path)
    stored, out = spark.read.parquet(path), None
    for name, a, b in SKETCH_RANGES:
        first, last = F.lit(a).cast("date"), F.lit(b).cast("date")
        got = sk.range_quantiles(stored, first, last)  # a row per measure and probability
        rows = prof.long_values(obs.filter(F.col("obs_date").between(first, last)), MEASURES).join(F.broadcast(got), "measure")
        ranks = rows.groupBy("measure", "p", "n").agg(
            F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("value") < F.col("quantile"), 1)).alias("below"),
            F.count(F.when(F.col("value") <= F.col("quantile"), 1)).alias("upto"))
        low, high = (F.col("p") - RANK_ERROR) * F.col("rows") - 1, (F.col("p") + RANK_ERROR) * F.col("rows") + 1
        part = ranks.select(F.lit(name).alias("dates"), "measure", "p", "n", ((F.col("below") <= high) & (F.col("upto") >= low)).alias("within"))
        out = part if out is None else out.unionByName(part)
    return out


# ----------------------------------------------------------------- M8: a forest of one split

_STUMP_SQL = sql.with_obs(
    *sql.split_ctes(cat.TRAIN_RATIO), f"m as (select cast(month(obs_date) as double) as month, {STUMP_TARGET} as y, split from split)",
    "tr as (select month, count(*) as n, sum(y) as s, sum(y * y) as q from m where split = 'train' group by month)",
    "cuts as (select (month + lead(month) over (order by month)) / 2 as cut from tr)",
    "sides as (select cut, sum(case when month <= cut then n else 0 end) as ln, sum(case when month <= cut then s else 0 end) as ls, "
    "sum(case when month > cut then n else 0 end) as rn, sum(case when month > cut then s else 0 end) as rs, sum(q) as q from cuts, tr where cut is not null group by cut)",
    "best as (select cut, ls / ln as left_mean, rs / rn as right_mean from sides order by q - ls * ls / ln - rs * rs / rn, cut limit 1)")


@cat.register("rf_stump", _STUMP_SQL
              + "select cast(month as bigint) as month, cast(count(*) as bigint) as n_rows, round(cut, 6) as split_value, round(left_mean, 6) as left_mean, round(right_mean, 6) as right_mean, "
                "round(case when month <= cut then left_mean else right_mean end, 6) as prediction from m, best where split = 'test' group by all")
def q_rf_stump(spark, sf_dir):
    """One depth-1 tree on the month, through the shipped training and scoring: the split of least variance, its means, and what is predicted."""
    rows = cat.split_table(spark, sf_dir).withColumn("month", F.month("obs_date").cast("double"))
    one = {"RF": dict(numTrees=1, maxDepth=1, bootstrap=False, featureSubsetStrategy="all")}
    models = mdl.train_models(rows.filter("split = 'train'"), ["month"], [STUMP_TARGET], ["RF"], params=one)
    value, left, right = mdl.stump_of(models[mdl.model_key("RF", STUMP_TARGET)])
    scored = sc.score_all(rows.filter("split = 'test'"), models)
    return scored.groupBy(F.col("month").cast("bigint").alias("month"), F.round(ev.pred_col("RF", STUMP_TARGET), 6).alias("prediction")).agg(F.count(F.lit(1)).alias("n_rows")).select(
        "month", "n_rows", F.round(F.lit(value), 6).alias("split_value"), F.round(F.lit(left), 6).alias("left_mean"), F.round(F.lit(right), 6).alias("right_mean"), "prediction")


# ----------------------------------------------------------------- E2: resamples of exactly n rows

def _exact_sql() -> str:
    u = "(cast(cast(('0x' || substr(md5(cast(rn - 1 as varchar) || '-' || cast(42 + r.range as varchar)), 1, 13)) as bigint) as double) / cast(4503599627370496 as double))"
    return (sql.with_obs(
        *sql.split_ctes(cat.TRAIN_RATIO), "t as (select *, row_number() over (order by obs_date, obs_id) as rn from split where split = 'test')",
        "c as (select count(*) as n from t)",
        f"draws as (select cast(r.range as bigint) as run, least(cast(floor({u} * cast(n as double)) as bigint), n - 1) + 1 as rn, count(*) as w "
        f"from t, c, range(1, {cat.BOOTSTRAP_RUNS + 1}) r group by 1, 2)",
        "j as (select run, w, t.* from draws join t using (rn))") + " union all ".join(
        f"select run, 'LAST' as algo, '{t}' as target, cast(sum(w) as bigint) as n_drawn, "
        f"round(sqrt(sum(w * ({cat._target_measure(t)} - {t}) * ({cat._target_measure(t)} - {t})) / sum(w)), 6) as rmse from j group by run" for t in cat.TARGETS))


@cat.register("exact_bootstrap_rmse", _exact_sql())
def q_exact_bootstrap_rmse(spark, sf_dir):
    return ev.exact_bootstrap_rmse(cat._last_test(spark, sf_dir), ["LAST"], cat.TARGETS, ["obs_date", "obs_id"], cat.BOOTSTRAP_RUNS)


# ----------------------------------------------------------------- S6, S7, T3: written order

def _report_text_sql() -> str:
    shown = " || ',' || ".join(f"case when {m} = floor({m}) then cast(cast({m} as bigint) as varchar) else cast({m} as varchar) end" for m in MEASURES)
    label = " ".join(f"when '{name}' then '{text}'" for name, text in prof.REPORT_LABELS.items())
    place = " ".join(f"when '{s}' then {i + 2}" for i, s in enumerate(prof.STAT_ROWS))
    rows = cat._statistics_report_sql()
    cut = rows.index("select 'count' as statistic")
    return (rows[:cut].rstrip() + f", report as ({rows[cut:]}) select cast(1 as bigint) as line_no, 'statistic,{','.join(MEASURES)}' as line union all "
            f"select cast(case statistic {place} end as bigint), case statistic {label} else statistic end || ',' || {shown} from report")


@cat.register("report_text", _report_text_sql())
def q_report_text(spark, sf_dir):
    """The statistics report as text: written in its fixed order, read back line by line."""
    stats = prof.advanced_statistics(observations(spark, sf_dir), MEASURES, digits=2)
    path = _folder(spark, "report")
    ingest.write_report_csv(prof.statistics_text(prof.statistics_by_row(stats, MEASURES), MEASURES), path, order=[F.col("place")], drop=("place",))
    return ingest.report_lines(spark, path)


@cat.register("ordered_export", sql.with_obs()
              + "select *, cast(row_number() over (order by obs_date, station, obs_id) as bigint) as pos from obs")
def q_ordered_export(spark, sf_dir):
    """Observations written in order to several files; the position of each row as read back from file number and row."""
    path = _folder(spark, "ordered")
    ingest.write_ordered(observations(spark, sf_dir), path, ["obs_date", "station", "obs_id"])
    return ingest.read_ordered(spark, path)


# ----------------------------------------------------------------- M3, A8: audit by the pass that writes

@cat.register("observed_audit", sql.with_obs(sql.mixed_clean_cte()) + " union all ".join(
    f"select '{phase}' as phase, '{m}' as column_name, cast(count(*) filter (where {m} is null) as bigint) as null_count from {src}"
    for phase, src in (("before", "obs"), ("after", "clean")) for m in MEASURES) + " union all select 'rows', cast(null as varchar), cast(count(*) as bigint) from obs")
def q_observed_audit(spark, sf_dir):
    return imp.write_filled(observations(spark, sf_dir), {"min_temp": "mean", "max_temp": "mean", "rainfall": "zero"}, _folder(spark, "filled"))


# ----------------------------------------------------------------- S2, S4: layout by year, CSV beside a missing table

@cat.register("context_window_by_year", cat.ORACLE["context_window"])
def q_context_window_by_year(spark, sf_dir):
    path = _folder(spark, "by-year")
    ingest.write_by_year(observations(spark, sf_dir), path, "obs_date")
    day = F.lit(cat.PICKED_DATE).cast("date")
    return ingest.read_dates(spark, path, F.date_sub(day, cat.CONTEXT_DAYS), F.date_add(day, cat.CONTEXT_DAYS), "obs_date")


@cat.register("csv_fallback", sql.with_obs() + "select * from obs")
def q_csv_fallback(spark, sf_dir):
    """The Parquet table asked for is not there; the CSV of its name is, and is read with inferred types."""
    folder = _folder(spark, "fallback")
    raw_text_observations(spark, sf_dir).write.option("header", True).csv(f"{folder}/obs.csv")
    return ingest.load_table(spark, f"{folder}/obs.parquet").withColumn("obs_id", F.col("obs_id").cast("bigint"))


# ----------------------------------------------------------------- S1, S3: rejects

_KINDS = {"obs_id": "bigint", "station": "string", "obs_date": "date", **{m: "double" for m in MEASURES}}


def spoiled_lines(spark, sf_dir):
    """CSV lines of the observations; by id, some lack a field or have one too many, some hold a date or a number that is none."""
    raw, i = raw_text_observations(spark, sf_dir), F.col("obs_id").cast("bigint")
    date = F.when(i % 29 == 0, F.lit("31/02/19x8")).otherwise(F.col("obs_date"))
    low = F.when(i % 31 == 0, F.lit("12,5 C".replace(",", ";"))).otherwise(F.col("min_temp"))
    whole = F.concat_ws(",", "obs_id", "station", date, low, "max_temp", "rainfall")
    return raw.select(F.when(i % 37 == 0, F.concat_ws(",", "obs_id", "station", date)).when(i % 41 == 0, F.concat(whole, F.lit(",x"))).otherwise(whole).alias("value"))


def spoiled_tables(spark, sf_dir):
    path = _folder(spark, "spoiled")
    spoiled_lines(spark, sf_dir).write.text(path)
    return ingest.read_with_rejects(spark, path, _KINDS, header=False)


_WELL = "obs_id % 37 <> 0 and obs_id % 41 <> 0"


@cat.register("reject_counts", sql.with_obs()
              + f"select 'malformed' as reason, cast(null as varchar) as column_name, cast(count(*) as bigint) as n from obs where not ({_WELL}) union all "
                f"select 'unparsable', 'obs_date', cast(count(*) as bigint) from obs where {_WELL} and obs_id % 29 = 0 union all "
                f"select 'unparsable', 'min_temp', cast(count(*) as bigint) from obs where {_WELL} and obs_id % 31 = 0 union all "
                f"select 'good', cast(null as varchar), cast(count(*) as bigint) from obs where {_WELL}")
def q_reject_counts(spark, sf_dir):
    good, rejects = spoiled_tables(spark, sf_dir)
    return rejects.groupBy("reason", "column_name").agg(F.count(F.lit(1)).alias("n")).unionByName(
        good.select(F.lit("good").alias("reason"), F.lit(None).cast("string").alias("column_name")).groupBy("reason", "column_name").agg(F.count(F.lit(1)).alias("n")))


@cat.register("good_rows", sql.with_obs()
              + f"select obs_id, station, case when obs_id % 29 <> 0 then obs_date end as obs_date, case when obs_id % 31 <> 0 then min_temp end as min_temp, max_temp, rainfall from obs where {_WELL}")
def q_good_rows(spark, sf_dir):
    return spoiled_tables(spark, sf_dir)[0]
