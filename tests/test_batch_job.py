"""End-to-end run over a small raw CSV in the original file layout."""

import datetime as dt
import math

from meteoframe.operators import models as mdl
from meteoframe.plans.batch_job import RAW_MEASURES, raw_spec, run_batch_job


def _write_csv(path):
    lines = ["Date,Location,MinTemp,MaxTemp,Rainfall,Evaporation,Sunshine,WindGustDir,RainToday"]
    start = dt.date(2010, 1, 1)
    for s, station in enumerate(["Albury", "Cairns", "Hobart"]):
        for d in range(80):
            day = start + dt.timedelta(days=d)
            lo = 5 + s * 4 + 6 * math.sin(d / 9.0)
            hi = lo + 9 + (d % 5)
            rain = "NA" if d % 13 == 0 else ("0" if d % 3 else f"{(d * 7 % 23) / 2:.1f}")
            mn = "NA" if d % 17 == 0 else f"{lo:.1f}"
            mx = "" if d % 19 == 0 else f"{hi:.1f}"
            lines.append(f"{day.isoformat()},{station},{mn},{mx},{rain},NA,7.5,W,No")
    lines.append("not-a-date,Albury,1,2,0,NA,NA,W,No")
    path.write_text("\n".join(lines) + "\n")


def test_reference_pipeline_end_to_end(spark, tmp_path):
    csv = tmp_path / "weather.csv"
    _write_csv(csv)
    res = run_batch_job(spark, str(csv), str(tmp_path / "out"), runs=3)
    assert res.statistics.count() == 3
    described = {r.column_name: r.description for r in res.dictionary.collect()}
    assert described["MinTemp"].startswith("Lowest temperature") and described["Location"] == "Observing station"
    audit = {(r.phase, r.column_name): r.null_count for r in res.null_audit.collect()}
    assert audit[("after", "MinTemp")] == 0 and audit[("before", "Rainfall")] > 0
    split = {r.split: r["count"] for r in res.split.groupBy("split").count().collect()}
    n = sum(split.values())
    assert split["train"] == int(n * 0.8)
    assert "MinTemp_L1" in res.split.columns and "Target_Rainfall_D2" in res.split.columns
    assert spark.read.parquet(res.test_path).count() == split["test"]
    report = res.report
    assert report.columns[:5] == ["Run_ID", "LR_Avg_Day1", "RF_Avg_Day1", "LR_Avg_Day2", "RF_Avg_Day2"]
    assert report.count() == 4
    loaded, missing = mdl.load_models(spark, res.model_dir, raw_spec().target_cols)
    assert not missing and len(loaded) == 12
    assert spark.read.option("header", True).csv(res.report_path).count() == 4
    assert set(RAW_MEASURES) <= set(spark.read.option("header", True).csv(str(tmp_path / "out" / "advanced_statistics")).columns)


def test_national_series(spark, tmp_path):
    csv = tmp_path / "weather.csv"
    _write_csv(csv)
    res = run_batch_job(spark, str(csv), str(tmp_path / "out"), runs=2, algos=("LR",), national=True)
    rows = res.split.count()
    assert rows == res.split.select("Date").distinct().count()     # one row per date
    assert rows == 80 - 7                                            # 5 lags + 2 leads lost at the ends


def test_scoring_screen(spark, tmp_path):
    import shutil

    from meteoframe.plans.batch_job import scoring_screen

    csv = tmp_path / "weather.csv"
    _write_csv(csv)
    out = tmp_path / "out"
    run_batch_job(spark, str(csv), str(out), runs=2)
    views = scoring_screen(spark, str(out))
    test_dates = spark.read.parquet(str(out / "test_data.parquet")).select("Date").distinct().count()
    assert views.dates.count() == min(50, test_dates) and not views.missing_models
    card = views.card.collect()
    assert len(card) == 6 and all(r.model_found for r in card)
    assert {r.advice for r in card if "Rainfall" in r.target} <= {"heavy", "light", "dry"}
    assert views.context.columns[:4] == ["Date", "Target_Rainfall_D1", "Target_MaxTemp_D1", "Target_MinTemp_D1"]
    assert views.context.count() == test_dates   # all test dates lie within +-30 days of the last one
    shutil.rmtree(out / "saved_models" / "RF_Target_MinTemp_D2")           # a model that no longer loads
    views = scoring_screen(spark, str(out))
    assert views.missing_models == ["RF_Target_MinTemp_D2"]
    gone = [r for r in views.card.collect() if r.target == "Target_MinTemp_D2"]
    assert gone and gone[0].prediction is None and not gone[0].model_found
