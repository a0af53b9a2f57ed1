"""Row index and halo lag/lead equal the single-partition window they replace."""

import json
import os
import re
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from meteoframe.operators.ordering import shift_columns, with_row_index, with_running_total
from meteoframe.sources.observations import observations
from tests.conftest import ROOT, SF_SMALL


def _plain_row_number(df, order):
    return df.withColumn("ref", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_row_index_equals_row_number(spark, parts):
    obs = observations(spark, SF_SMALL)
    got = with_row_index(obs, ["obs_date", "obs_id"], "idx", num_partitions=parts)
    ref = _plain_row_number(obs, ["obs_date", "obs_id"]).select("obs_id", "ref")
    assert got.join(ref, "obs_id").filter("idx <> ref").count() == 0
    assert got.count() == obs.count()


@pytest.mark.parametrize("partition_by,bucket", [(["station"], 7), ([], 7), (["station"], 64), ([], 1 << 20)])
def test_halo_shift_equals_window(spark, partition_by, bucket):
    obs = observations(spark, SF_SMALL)
    shifts = [("min_temp", 1, "l1"), ("max_temp", 5, "l5"), ("rainfall", -2, "d2"), ("rainfall", -1, "d1")]
    got = shift_columns(obs, shifts, ["obs_date", "obs_id"], partition_by, bucket_rows=bucket, num_partitions=4)
    w = Window.partitionBy(*partition_by).orderBy("obs_date", "obs_id") if partition_by else Window.orderBy("obs_date", "obs_id")
    ref = obs.select("obs_id", F.lag("min_temp", 1).over(w).alias("r1"), F.lag("max_temp", 5).over(w).alias("r5"),
                     F.lead("rainfall", 2).over(w).alias("rd2"), F.lead("rainfall", 1).over(w).alias("rd1"))
    j = got.join(ref, "obs_id")
    bad = j.filter(~F.col("l1").eqNullSafe(F.col("r1")) | ~F.col("l5").eqNullSafe(F.col("r5"))
                   | ~F.col("d2").eqNullSafe(F.col("rd2")) | ~F.col("d1").eqNullSafe(F.col("rd1")))
    assert bad.count() == 0
    assert got.count() == obs.count()


def test_hot_key_is_spread(spark):
    """A single station holding every row still spreads over all range partitions."""
    obs = observations(spark, SF_SMALL).withColumn("station", F.lit("one"))
    got = with_row_index(obs, ["station", "obs_date", "obs_id"], "idx", num_partitions=8)
    sizes = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(sizes) >= 6
    assert max(r["count"] for r in sizes) < obs.count() / 2


def test_running_total(spark):
    df = spark.range(1, 501).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"), F.lit(2).alias("w"))
    got = with_running_total(df, ["k", "v"], "w", "cum", num_partitions=5)
    ref = df.withColumn("ref", F.sum("w").over(Window.orderBy("k", "v").rowsBetween(Window.unboundedPreceding, 0)))
    assert got.join(ref.select("k", "v", "ref"), ["k", "v"]).filter("cum <> ref").count() == 0


def _final_plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text[:text.index("== Initial Plan ==")] if "== Initial Plan ==" in text else text


@pytest.mark.parametrize("what", ["lags", "index", "total"])
def test_rows_are_dealt_by_one_shared_exchange(spark, what):
    """Whole rows move once: branches that need sizes or edges reuse the exchange of the rows."""
    obs = observations(spark, SF_SMALL)
    shifts = [("min_temp", 5, "l5"), ("rainfall", -2, "d2")]
    df = {"lags": lambda: shift_columns(obs, shifts, ["obs_date", "obs_id"], ["station"], min_bucket_rows=64).select("obs_id", "l5", "d2"), "index": lambda: with_row_index(obs, ["obs_date", "obs_id"]).select("obs_id", "row_idx"),
          "total": lambda: with_running_total(obs.select("obs_id", F.lit(1).alias("w")), ["obs_id"], "w")}[what]()
    plan = _final_plan(df)
    stages = set(re.findall(r"ShuffleQueryStage \d+\n[ :|]*\+- Exchange shufflepartitionidpassthrough", plan))
    assert len(stages) == 1, plan
    assert "ReusedExchange" in plan


def test_shuffled_records_are_the_rows_and_a_few_per_range(tmp_path):
    """The event log of a session of its own: what lags write to the shuffle is every row once, and 7 rows and a mark per range."""
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from meteoframe.session import get_session
        from pyspark.sql import SparkSession
        SparkSession.builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://{tmp_path}").config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false").master("local[4]").config("spark.ui.enabled", "false").getOrCreate()
        spark = get_session("local[4]", shuffle_partitions=6)
        from meteoframe.operators import series
        from meteoframe.sources.observations import observations
        obs = observations(spark, {SF_SMALL!r})
        df = series.lag_lead_features(obs, drop_incomplete=False)
        spark.sparkContext.setJobGroup("lags", "lags")
        print("ROWS", obs.count(), "OUT", len(df.collect()))
        spark.stop()
    """)
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=600, env=dict(os.environ, PYTHONPATH=ROOT))
    rows = int(re.search(r"ROWS (\d+)", done.stdout)[1])
    stages, written = set(), 0
    for path in tmp_path.iterdir():
        for line in path.read_text().splitlines():
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart" and (e.get("Properties") or {}).get("spark.jobGroup.id") == "lags":
                stages |= set(e["Stage IDs"])
            elif e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in stages:
                written += e["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Records Written"]
    # count() writes a row per task; the exchange of whole rows, the edges, the marks and the counts of the gap filling's own aggregates
    assert rows <= written <= rows + 6 * (7 + 2) + 40, (rows, written)


@pytest.mark.parametrize("op", ["lags", "index", "per station"])
def test_a_repeated_key_is_refused(spark, op):
    obs = observations(spark, SF_SMALL)
    twice = obs.unionByName(obs.filter("obs_id = 7"))
    shifts, cols = [("min_temp", 1, "l1"), ("rainfall", -2, "d2")], ["obs_date", "obs_id"]
    make = {"lags": lambda d: shift_columns(d, shifts, cols, num_partitions=5), "per station": lambda d: shift_columns(d, shifts, cols, ["station"], bucket_rows=50),
            "index": lambda d: with_row_index(d, cols, num_partitions=5)}[op]
    assert make(obs).count() == obs.count()
    with pytest.raises(Exception, match="no total order.*obs_id=7"):
        make(twice).count()


def test_null_keys_and_short_ranges(spark):
    """Null keys come first; series, gaps and ranges shorter than the lags are crossed; repeated null keys are refused too."""
    rows = [(None if i % 11 == 0 else f"s{i % 4}", None if i % 13 == 0 else i // 3, i, float(i)) for i in range(120)]
    df = spark.createDataFrame(rows, "s string, d int, i int, v double").repartition(7)
    shifts = [("v", k, f"b{k}") for k in (1, 5)] + [("v", -k, f"a{k}") for k in (1, 2)]
    for by, ranges in ((["s"], 40), ([], 60), (["s"], 1)):
        got = shift_columns(df, shifts, ["d", "i"], by, num_partitions=ranges, min_bucket_rows=1, index_col="n")
        w = Window.partitionBy(*by).orderBy("d", "i")
        want = df.select("i", *[(F.lag(c, k) if k > 0 else F.lead(c, -k)).over(w).alias(n) for c, k, n in shifts],
                         F.row_number().over(Window.orderBy(*by, "d", "i")).alias("n"))
        names = ["i", "n", *[n for _, _, n in shifts]]
        assert got.count() == 120 and {tuple(r) for r in got.select(names).collect()} == {tuple(r) for r in want.select(names).collect()}
    with pytest.raises(Exception, match="no total order"):
        with_row_index(df.select(F.lit(None).cast("int").alias("a"), "s"), ["a", "s"]).collect()


def test_hot_station_window_tasks_are_bounded(spark):
    """One station with a third of all rows: every (bucket, station) window group stays <= bucket + halo."""
    obs = observations(spark, SF_SMALL).withColumn(
        "station", F.when(F.col("obs_id") % 3 == 0, F.lit("hot")).otherwise(F.col("station")))
    bucket = 50
    shifts = [("min_temp", 5, "l5"), ("rainfall", -2, "d2")]
    got = shift_columns(obs, shifts, ["obs_date", "obs_id"], ["station"], bucket_rows=bucket, num_partitions=4,
                        index_col="gidx")
    w = Window.partitionBy("station").orderBy("obs_date", "obs_id")
    ref = obs.select("obs_id", F.lag("min_temp", 5).over(w).alias("r5"), F.lead("rainfall", 2).over(w).alias("rd2"))
    bad = got.join(ref, "obs_id").filter(~F.col("l5").eqNullSafe(F.col("r5")) | ~F.col("d2").eqNullSafe(F.col("rd2")))
    assert bad.count() == 0
    groups = got.groupBy(F.floor((F.col("gidx") - 1) / bucket).alias("b"), "station").count()
    assert groups.agg(F.max("count")).collect()[0][0] <= bucket


def test_results_do_not_depend_on_a_cache(spark, tmp_path):
    """Input in 12 files, cache cleared between planning and the action: positions and lags equal the window functions'."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    path = str(tmp_path / "obs")
    observations(spark, SF_SMALL).repartition(12, "obs_id").write.parquet(path)
    obs = spark.read.parquet(path)
    cols = ["obs_date", "obs_id"]
    index = with_row_index(obs, cols, "i")
    lags = shift_columns(obs, [("max_temp", 1, "lag"), ("max_temp", -2, "lead")], cols, bucket_rows=64, min_bucket_rows=8)
    totals = with_running_total(obs.select(*cols, F.lit(1).alias("w")), cols, "w")
    spark.catalog.clearCache()
    w = Window.orderBy(*cols)
    want = obs.select("obs_id", F.row_number().over(w).alias("i"), F.lag("max_temp", 1).over(w).alias("lag"), F.lead("max_temp", 2).over(w).alias("lead"))
    rows = {r["obs_id"]: r for r in want.collect()}
    assert {r["obs_id"]: r["i"] for r in index.collect()} == {k: r["i"] for k, r in rows.items()}
    assert {r["obs_id"]: (r["lag"], r["lead"]) for r in lags.collect()} == {k: (r["lag"], r["lead"]) for k, r in rows.items()}
    assert {r["obs_id"]: r["cum"] for r in totals.collect()} == {k: r["i"] for k, r in rows.items()}


def test_drop_stages(spark, tmp_path):
    from meteoframe.plans import stages

    df = stages.materialize(spark.range(10), "drop-me")
    assert df.count() == 10
    assert stages.drop_stages(spark, {"drop-me"}) == 1
    assert all(label != "drop-me" for label, _ in stages._WRITTEN)
