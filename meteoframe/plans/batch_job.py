"""End-to-end run over a raw daily-observation CSV (Date, Location, MinTemp, ...).

The whole flow of the original batch job, composed from the operators:
read -> type -> profile report -> null audit and gap filling -> lag/lead
features -> chronological split -> test table -> twelve models -> bootstrap
report. Names follow the raw file (``MinTemp_L1``, ``Target_MinTemp_D1``);
the station key is ``Location`` and ``(Date, Location)`` is the total order.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteoframe.operators import evaluate as ev
from meteoframe.operators import impute as imp
from meteoframe.operators import models as mdl
from meteoframe.operators import profile as prof
from meteoframe.operators import score as sc
from meteoframe.operators import series as ser
from meteoframe.plans.stages import materialize
from meteoframe.session import ensure_checkpoint_dir
from meteoframe.sources import ingest
from meteoframe.spec import FeatureSpec

# The modelled measures and the key columns of the raw file.
RAW_MEASURES = ("MinTemp", "MaxTemp", "Rainfall")
DATE_COL = "Date"
STATION_COL = "Location"
ROW_KEY = "row_key"


@dataclass
class BatchJobResult:
    statistics: DataFrame
    dictionary: DataFrame
    null_audit: DataFrame
    split: DataFrame
    models: dict[str, PipelineModel]
    report: DataFrame
    test_path: str
    model_dir: str
    report_path: str


def raw_spec(per_station: bool = True) -> FeatureSpec:
    return FeatureSpec(measures=RAW_MEASURES, partition_by=(STATION_COL,) if per_station else (),
                       order_by=(DATE_COL,), tie_break=(STATION_COL,))


def read_raw(spark: SparkSession, csv_path: str) -> DataFrame:
    """Header CSV read as text, then typed where the columns exist."""
    text = spark.read.option("header", True).option("nullValue", "NA").csv(csv_path)
    return ingest.typed_observations(text, (DATE_COL,), ingest.RAW_NUMERIC)


def run_batch_job(spark: SparkSession, csv_path: str, out_dir: str, per_station: bool = True,
                           train_ratio: float = 0.8, runs: int = 10, algos=mdl.ALGOS,
                           national: bool = False) -> BatchJobResult:
    """``national=True`` first averages the filled measures over all stations per
    date (one national series, one row per date); otherwise one series per
    ``Location`` (or the global order with ``per_station=False``)."""
    spec = raw_spec(per_station or national)
    out = out_dir.rstrip("/")
    mean_cols = RAW_MEASURES[:2]
    stage = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stages/batch-{uuid.uuid4().hex}"
    means = imp.observed_means(read_raw(spark, csv_path), mean_cols, f"{stage}/typed")  # the only read of the file's rows
    typed = spark.read.parquet(f"{stage}/typed")

    stats = prof.advanced_statistics(typed, RAW_MEASURES)
    dictionary = prof.data_dictionary(typed, ingest.RAW_DESCRIPTIONS, "Other measure")
    ingest.write_report_csv(prof.statistics_text(prof.statistics_by_row(stats, RAW_MEASURES), RAW_MEASURES), f"{out}/advanced_statistics",
                            order=[F.col("place")], drop=("place",))
    ingest.write_report_csv(dictionary, f"{out}/data_dictionary")

    placed = [DATE_COL, STATION_COL] if per_station and not national else [DATE_COL]
    if STATION_COL not in typed.columns and len(placed) == 1:
        typed = typed.withColumn(STATION_COL, F.lit("all"))
    obs = typed.select(DATE_COL, STATION_COL, *RAW_MEASURES)
    policy = {**means, RAW_MEASURES[2]: "zero"}
    audit = imp.write_filled(obs, policy, f"{stage}/filled").filter("phase <> 'rows'")  # counted by the pass that fills and writes
    # Audit and fill values come from all rows; those that cannot be placed in a series go only then.
    filled = spark.read.parquet(f"{stage}/filled").dropna(subset=placed).fillna("", subset=[STATION_COL])
    if national:
        daily = ser.national_daily(filled, RAW_MEASURES, DATE_COL).drop("n_obs")
        filled = materialize(daily.withColumn(STATION_COL, F.lit("national")), "batch-daily")
    # The position of a row in the order identifies it; a repeated date and station is refused here.
    feats = materialize(ser.lag_lead_features(filled, spec, index_col=ROW_KEY), "batch-features")
    split = ser.chronological_split(feats, train_ratio, date_col=DATE_COL, id_col=ROW_KEY)
    train = split.filter(F.col("split") == "train")
    test = split.filter(F.col("split") == "test")
    test_path = f"{out}/test_data.parquet"
    ingest.write_parquet(test, test_path)

    models = mdl.train_models(train, spec.feature_cols, spec.target_cols, algos, key_cols=(ROW_KEY,))
    model_dir = f"{out}/saved_models"
    mdl.save_models(models, model_dir)

    scored = sc.score_all(test, models)
    boot = ev.bootstrap_rmse(scored, algos, spec.target_cols, runs, key_col=ROW_KEY)
    report = ev.bootstrap_report(boot, algos, spec.target_cols, spec.leads)
    report_path = f"{out}/bootstrap_evaluation"
    ingest.write_report_csv(report, report_path, order=[F.col("Run_ID").try_cast("int").asc_nulls_last()])
    return BatchJobResult(stats, dictionary, audit, split, models, report, test_path, model_dir, report_path)


@dataclass
class ScreenViews:
    dates: DataFrame
    day: object
    card: DataFrame
    context: DataFrame
    missing_models: list[str]


# Display names of the day-1 predictions on the context chart.
_PRED_NAMES = {"Target_MinTemp_D1": "Pred_Min", "Target_MaxTemp_D1": "Pred_Max", "Target_Rainfall_D1": "Pred_Rain"}


def scoring_screen(spark: SparkSession, out_dir: str, day=None, algo: str = "RF", days: int = 30,
                   n_dates: int = 50, default: float | None = None) -> ScreenViews:
    """The data behind the scoring screen, from the outputs of ``run_batch_job``.

    Latest ``n_dates`` dates of the test table; for the chosen day (default:
    the latest) one representative row per date scored by every saved model
    (prediction, actual, delta, rain advice, lag-1 context); and +-``days``
    of day-1 predictions against actual values, in the order of the dates.
    Missing models predict ``default`` (null unless given; the original screen
    shows 0.0) and have ``model_found = false``.
    """
    out = out_dir.rstrip("/")
    spec = raw_spec()
    test = ingest.load_table(spark, f"{out}/test_data.parquet")
    if test is None:
        raise FileNotFoundError(f"{out}/test_data.parquet")
    dates = ser.recent_dates(test, n_dates, DATE_COL)
    if day is None:
        day = dates.first()[DATE_COL]
    models, missing = mdl.load_models(spark, f"{out}/saved_models", spec.target_cols)
    mine = {k: m for k, m in models.items() if k.startswith(f"{algo}_")}
    lost = [k for k in missing if k.startswith(f"{algo}_")]

    row = ser.one_row_per_date(ser.observation_on_date(test, day, DATE_COL), DATE_COL, (STATION_COL,))
    scored = sc.with_missing_predictions(sc.score_all(row, mine), lost, default)
    context = [spec.lag_col(m, 1) for m in RAW_MEASURES]
    card = sc.forecast_card(scored, (algo,), spec.target_cols, rain_measure="Rainfall",
                            context_cols=context, keys=(STATION_COL, DATE_COL), missing=lost)

    around = ser.one_row_per_date(ser.context_window(test, day, days, DATE_COL), DATE_COL, (STATION_COL,))
    day1 = [spec.target_col(m, 1) for m in RAW_MEASURES]
    day1_models = {k: m for k, m in mine.items() if k.split("_", 1)[1] in day1}
    lost1 = [f"{algo}_{t}" for t in day1 if f"{algo}_{t}" not in day1_models]
    chart = sc.with_missing_predictions(sc.score_all(around, day1_models), lost1, default)
    chart = sc.actual_vs_predicted(chart, algo, day1, _PRED_NAMES, date_col=DATE_COL).orderBy(DATE_COL)
    return ScreenViews(dates, day, card, chart, missing)


def main(argv=None) -> None:
    """``python -m meteoframe.plans.batch_job weather.csv out_dir [--global | --national]``."""
    import argparse

    from meteoframe.session import get_session

    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("csv_path")
    ap.add_argument("out_dir")
    mode = ap.add_mutually_exclusive_group()
    mode.add_argument("--global", dest="global_order", action="store_true", help="one global order, no station key")
    mode.add_argument("--national", action="store_true", help="one national series (daily mean over stations)")
    ap.add_argument("--train-ratio", type=float, default=0.8)
    ap.add_argument("--runs", type=int, default=10)
    args = ap.parse_args(argv)
    spark = get_session()
    res = run_batch_job(spark, args.csv_path, args.out_dir, per_station=not args.global_order,
                        train_ratio=args.train_ratio, runs=args.runs, national=args.national)
    res.report.orderBy(F.col("Run_ID").try_cast("int").asc_nulls_last()).show(truncate=False)


if __name__ == "__main__":
    main()
