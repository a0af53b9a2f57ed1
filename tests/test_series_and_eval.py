"""Split invariants, boundary view, bootstrap weights, report layout."""

import pytest
from pyspark.sql import functions as F

from meteoframe.functions.columns import poisson1_cdf, poisson1_weight, unit_hash
from meteoframe.operators import evaluate as ev
from meteoframe.operators import series as ser
from meteoframe.plans import catalog
from meteoframe.sources.observations import observations
from tests.conftest import SF_SMALL


def test_split_sizes_and_order(spark):
    s = catalog.split_table(spark, SF_SMALL)
    n = s.count()
    counts = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts["train"] == int(n * 0.8) and counts["test"] == n - int(n * 0.8)
    bounds = s.groupBy("split").agg(F.max("obs_date").alias("hi"), F.min("obs_date").alias("lo")).collect()
    b = {r.split: r for r in bounds}
    assert b["train"].hi <= b["test"].lo


def test_split_gap(spark):
    feats = catalog.features(spark, SF_SMALL)
    s = ser.chronological_split(feats, 0.8, gap=2)
    assert s.filter("split = 'gap'").count() == 2


def test_boundary_slice(spark):
    b = catalog.boundary_slice(spark, SF_SMALL)
    types = {r.Type: r["count"] for r in b.groupBy("Type").count().collect()}
    assert types == {"Train": 100, "Test": 100}
    pos = ser.split_position(b).collect()[0]
    assert pos.split_pos == 100 and pos.n_rows == 200


def test_one_row_per_date_is_first_by_station_then_id(spark):
    obs = observations(spark, SF_SMALL)
    got = {r.obs_date: r.obs_id for r in ser.one_row_per_date(obs).collect()}
    ref = obs.groupBy("obs_date").agg(F.min(F.struct("station", "obs_id")).alias("s")).collect()
    assert got == {r.obs_date: r.s.obs_id for r in ref}


def test_poisson_weights_have_unit_mean(spark):
    df = spark.range(200000).select(poisson1_weight(unit_hash(F.col("id"), F.lit(43))).alias("w"))
    st = df.agg(F.avg("w").alias("m"), F.variance("w").alias("v")).collect()[0]
    assert st.m == pytest.approx(1.0, abs=0.01)
    assert st.v == pytest.approx(1.0, abs=0.02)
    assert poisson1_cdf()[0] == pytest.approx(0.36787944117144233)


def test_bootstrap_independent_of_partitioning(spark):
    s = catalog.split_table(spark, SF_SMALL).filter("split = 'test'")
    last = ev.persistence_predictions(s)
    a = sorted(ev.bootstrap_rmse(last.repartition(1), ["LAST"], catalog.TARGETS, 3).collect())
    b = sorted(ev.bootstrap_rmse(last.repartition(7), ["LAST"], catalog.TARGETS, 3).collect())
    assert a == b


def test_report_layout(spark):
    s = catalog.split_table(spark, SF_SMALL).filter("split = 'test'")
    boot = ev.bootstrap_rmse(ev.persistence_predictions(s), ["LAST"], catalog.TARGETS, 10)
    rep = ev.bootstrap_report(boot, ["LAST"], catalog.TARGETS)
    assert rep.columns[:3] == ["Run_ID", "LAST_Avg_Day1", "LAST_Avg_Day2"]
    ids = [r.Run_ID for r in rep.collect()]
    assert sorted(ids) == sorted([str(i) for i in range(1, 11)] + ["FINAL_AVERAGE"])


@pytest.mark.parametrize("hot", [False, True])
def test_key_at_rank_equals_row_number(spark, hot):
    from pyspark.sql import Window

    obs = observations(spark, SF_SMALL)
    if hot:  # half of the rows on one date
        obs = obs.withColumn("obs_date", F.when(F.col("obs_id") % 2 == 0, F.lit("1998-01-01").cast("date"))
                             .otherwise(F.col("obs_date")))
    ref = obs.withColumn("rn", F.row_number().over(Window.orderBy("obs_date", "obs_id")))
    n = obs.count()
    for rank in (1, 2, n // 3, n // 2, n - 1, n):
        want = ref.filter(F.col("rn") == rank).select("obs_date", "obs_id").collect()[0]
        assert ser.key_at_rank(obs, rank) == (want.obs_date, want.obs_id)
