"""What is written and read back: order, layout, sketches, audits, rejects; exact resamples and the forest of one split."""

import math

import pytest
from pyspark.sql import functions as F

from meteoframe.operators import evaluate as ev
from meteoframe.operators import impute as imp
from meteoframe.operators import models as mdl
from meteoframe.operators import sketches as sk
from meteoframe.plans import catalog, stored
from tests.compare import compare
from meteoframe.sources import ingest
from meteoframe.sources.observations import MEASURES, observations
from tests.conftest import SF_SMALL

PLANS = ["stored_sketch_quantiles", "rf_stump", "exact_bootstrap_rmse", "report_text", "ordered_export", "observed_audit",
         "context_window_by_year", "csv_fallback", "reject_counts", "good_rows"]


@pytest.mark.parametrize("name", PLANS)
def test_plan_equals_sql(spark, duck_small, name):
    found = compare(catalog.QUERIES[name](spark, SF_SMALL), duck_small, catalog.ORACLE[name])
    assert found["match"] and found["spark_rows"] > 0, found


def test_exact_resample_is_exact_and_independent_of_the_layout(spark):
    df = spark.range(1, 778).select(F.col("id").alias("k"), (F.col("id") % 7).alias("d"))
    seen = []
    for parts in (2, 4, 8):
        rows, draws = ev.exact_resample(df.repartition(parts), ["d", "k"], runs=3)
        assert rows.count() == 777
        assert {r["run"]: r["n"] for r in draws.groupBy("run").agg(F.sum("w").alias("n")).collect()} == {1: 777, 2: 777, 3: 777}
        seen.append(sorted(map(tuple, draws.join(rows, "row_idx").select("run", "k", "w").collect())))
    assert seen[0] == seen[1] == seen[2]
    share = sum(w for run, _, w in seen[0] if run == 1 and w == 1) / 777  # multinomial: about 1/e of the rows once
    assert abs(share - math.exp(-1)) < 0.06
    assert ev.exact_resample(df.limit(0), ["d", "k"])[1].count() == 0


def test_dates_read_only_the_folders_of_their_years(spark, tmp_path):
    path = str(tmp_path / "by_year")
    obs = observations(spark, SF_SMALL).unionByName(spark.createDataFrame([(-1, "s", None, 1.0, 2.0, 3.0)], observations(spark, SF_SMALL).schema))
    ingest.write_by_year(obs, path, "obs_date")
    first, last = F.lit("1996-12-20").cast("date"), F.lit("1997-01-05").cast("date")
    got = ingest.read_dates(spark, path, first, last, "obs_date")
    want = observations(spark, SF_SMALL).filter(F.col("obs_date").between(first, last))
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect())) and got.count() > 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    scan = [x for x in plan.splitlines() if "FileScan" in x][0]
    assert "PartitionFilters: [isnotnull(year" in scan and "PushedFilters: [IsNotNull(obs_date), GreaterThanOrEqual(obs_date" in scan, scan
    assert spark.read.parquet(path).count() == obs.count()


def test_ordered_files_follow_the_order(spark, tmp_path):
    path = str(tmp_path / "ordered")
    df = spark.range(5000).select(F.when(F.col("id") % 50 > 0, (F.col("id") * 7919) % 5003).alias("a"), F.col("id").alias("b")).repartition(7)
    ingest.write_ordered(df, path, ["a", "b"], files=12)
    back = ingest.read_ordered(spark, path)
    rows = sorted(map(tuple, back.select("pos", "a", "b").collect()))
    assert [r[0] for r in rows] == list(range(1, 5001))
    assert [r[1:] for r in rows] == sorted((r[1:] for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert 10 <= spark.read.parquet(path).select(F.input_file_name()).distinct().count() <= 12


def test_rejects_name_file_reason_and_line(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,day,x\n1,2020-01-01,1.5\n2,oops,NA\n3,2020-01-03\n\n")
    (tmp_path / "b.csv").write_text("id,day,x\nbad,nope,1..5\n5,,\n6,2020-01-06,7,8\n")
    good, rejects = ingest.read_with_rejects(spark, str(tmp_path), {"id": "bigint", "day": "date", "x": "double"})
    assert sorted(((r["id"], str(r["day"]), r["x"]) for r in good.collect()), key=str) == sorted(
        [(1, "2020-01-01", 1.5), (2, "None", None), (None, "None", None), (5, "None", None)], key=str)
    assert sorted(map(tuple, rejects.select("file", "reason", "column_name", "line").collect()), key=str) == sorted([
        ("a.csv", "unparsable", "day", "2,oops,NA"), ("a.csv", "malformed", None, "3,2020-01-03"), ("b.csv", "unparsable", "id", "bad,nope,1..5"),
        ("b.csv", "unparsable", "day", "bad,nope,1..5"), ("b.csv", "unparsable", "x", "bad,nope,1..5"), ("b.csv", "malformed", None, "6,2020-01-06,7,8")], key=str)


def test_sketches_answer_ranges_and_take_new_dates(spark, tmp_path):
    path, obs = str(tmp_path / "sketches"), observations(spark, SF_SMALL)
    old = F.col("obs_date") < "1996-01-01"
    sk.daily_sketches(obs.filter(old), MEASURES).write.parquet(path)
    sk.daily_sketches(obs.filter(~old), MEASURES).write.mode("append").parquet(path)
    stored_rows = spark.read.parquet(path)
    first, last = F.lit("1900-01-01").cast("date"), F.lit("2100-01-01").cast("date")
    got = {(r["measure"], r["p"]): r for r in sk.range_quantiles(stored_rows, first, last, (0.1, 0.5)).collect()}
    for m in MEASURES:
        x = sorted(r[0] for r in obs.select(m).dropna().collect())
        for p in (0.1, 0.5):
            r = got[m, p]
            below, upto = sum(v < r["quantile"] for v in x), sum(v <= r["quantile"] for v in x)
            assert r["n"] == len(x) and below <= (p + 0.01) * len(x) + 1 and upto >= (p - 0.01) * len(x) - 1
    assert sk.range_quantiles(stored_rows, F.lit("1900-01-01").cast("date"), F.lit("1900-02-01").cast("date")).count() == 0


def test_observed_audit_equals_the_counted_one(spark, tmp_path):
    obs, path = observations(spark, SF_SMALL), str(tmp_path / "filled")
    policy = {"min_temp": "mean", "max_temp": 1.5, "rainfall": "zero"}
    audit = imp.write_filled(obs, policy, path)
    rows = lambda d: sorted(map(tuple, d.collect()))
    assert rows(audit.filter("phase <> 'rows'")) == rows(imp.null_audit_filled(obs, policy).select("phase", "column_name", "null_count"))
    assert rows(spark.read.parquet(path)) == rows(imp.impute(obs, policy))
    means = imp.observed_means(obs, ["min_temp", "max_temp"], str(tmp_path / "typed"))
    assert means == {c: pytest.approx(obs.agg(F.avg(c)).first()[0]) for c in means}


def test_training_partitions_grow_with_rows_and_stay_schedulable():
    sizes = [mdl.training_partitions(n) for n in (0, 1, 1 << 14, (1 << 14) + 1, 1 << 22, 10**9, 10**11)]
    assert sizes == sorted(sizes) and sizes[:5] == [1, 1, 1, 2, 256] and sizes[5] < 1_300 and sizes[6] < 100_000


def test_forests_do_not_depend_on_the_fits_beside_them(spark):
    """At sf0.01, with one partition more than one: a forest alone, with two targets, and under other shuffle settings."""
    train = catalog.split_table(spark, "/root/testdata/sf0.01").filter("split = 'train'").select("obs_id", *catalog.FEATURES, *catalog.TARGETS)
    small = {"RF": dict(numTrees=4, maxDepth=3)}
    target = catalog.TARGETS[0]
    def trees(targets, shuffle):
        was = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", shuffle)
        try:
            return mdl.regressor_of(mdl.train_models(train, catalog.FEATURES, targets, ["RF"], num_partitions=3, params=small)[f"RF_{target}"]).toDebugString.split("\n", 1)[1]
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", was)
    alone = trees([target], "4")
    assert alone == trees(catalog.TARGETS[:2], "4") == trees([target], "9")


def test_refused_repeats_in_the_batch_job(spark, tmp_path):
    from meteoframe.plans.batch_job import run_batch_job
    from tests.test_batch_job import _write_csv

    csv = tmp_path / "weather.csv"
    _write_csv(csv)
    csv.write_text(csv.read_text() + csv.read_text().splitlines()[5] + "\n")
    with pytest.raises(Exception, match="no total order"):
        run_batch_job(spark, str(csv), str(tmp_path / "out"), runs=1, algos=("LR",))


def test_stump_of_reads_the_split_in_the_features_unit(spark):
    rows = [(i, float(i % 12 + 1), 10.0 if i % 12 + 1 <= 5 else 30.0) for i in range(240)]
    train = spark.createDataFrame(rows, "obs_id long, month double, y double")
    model = mdl.train_models(train, ["month"], ["y"], ["RF"], params={"RF": dict(numTrees=1, maxDepth=1, bootstrap=False, featureSubsetStrategy="all")})["RF_y"]
    assert mdl.stump_of(model) == pytest.approx((5.5, 10.0, 30.0))
    assert stored.STUMP_TARGET in catalog.TARGETS
