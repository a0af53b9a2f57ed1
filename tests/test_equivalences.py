"""Hand cases and equivalences from the test plan."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from meteoframe.operators import features as feat
from meteoframe.operators import impute as imp
from meteoframe.operators import models as mdl
from meteoframe.operators import series as ser
from meteoframe.plans import catalog
from meteoframe.spec import REFERENCE_SPEC
from tests.conftest import SF_SMALL


def _tiny(spark):
    d = dt.date
    rows = [  # two stations, ties on 2020-01-02, one null, one NaN
        (1, "A", d(2020, 1, 1), 10.0, 20.0, 0.0),
        (2, "A", d(2020, 1, 2), 11.0, 21.0, None),
        (3, "A", d(2020, 1, 2), 12.0, float("nan"), 1.0),
        (4, "A", d(2020, 1, 3), 13.0, 23.0, 2.0),
        (5, "B", d(2020, 1, 1), 5.0, 15.0, 0.0),
        (6, "B", d(2020, 1, 3), 6.0, 16.0, 3.0),
        (7, "A", d(2020, 1, 4), 14.0, 24.0, 0.0),
        (8, "B", d(2020, 1, 4), 7.0, 17.0, 0.0),
    ]
    return spark.createDataFrame(rows, "obs_id long, station string, obs_date date, min_temp double, max_temp double, rainfall double")


def test_hand_lags_with_ties(spark):
    spec = REFERENCE_SPEC.with_(lags=2, used_lags=1, leads=1)
    out = ser.lag_lead_features(_tiny(spark), spec, bucket_rows=2, drop_incomplete=False)
    got = {r.obs_id: (r.min_temp_L1, r.min_temp_L2, r.Target_min_temp_D1) for r in out.collect()}
    assert got[1] == (None, None, 11.0)
    assert got[2] == (10.0, None, 12.0)       # tie on the date broken by obs_id
    assert got[3] == (11.0, 10.0, 13.0)
    assert got[7] == (13.0, 12.0, None)
    assert got[5] == (None, None, 6.0)        # station B never sees station A
    assert got[8] == (6.0, 5.0, None)


def test_hand_mixed_imputation(spark):
    out = {r.obs_id: r for r in imp.impute_mixed(_tiny(spark)).collect()}
    mean_max = (20 + 21 + 23 + 15 + 16 + 24 + 17) / 7
    assert out[3].max_temp == pytest.approx(mean_max)   # NaN filled with the mean of the rest
    assert out[2].rainfall == 0.0                        # missing rain is no rain


def test_scaler_equals_sql_twin(spark):
    s = catalog.split_table(spark, SF_SMALL)
    train = s.filter("split = 'train'")
    cols = catalog.FEATURES
    mllib = feat.scaled_columns(feat.fit_scaling(train, cols).transform(s.select("obs_id", *cols)), cols)
    twin = feat.standardize_columns(s.select("obs_id", *cols), cols, fit_on=train)
    j = mllib.alias("a").join(twin.alias("b"), "obs_id")
    worst = j.select(F.max(F.greatest(*[F.abs(F.col(f"a.{c}_z") - F.col(f"b.{c}_z")) for c in cols])).alias("m")).collect()[0].m
    assert worst < 1e-9


def test_forward_window_is_lag_lead_reanchored(spark):
    obs = imp.impute_mean(catalog.observations(spark, SF_SMALL), REFERENCE_SPEC.measures)
    fwd = ser.forward_window_features(obs)
    spec = REFERENCE_SPEC.with_(lags=4, used_lags=4, leads=2)
    back = ser.lag_lead_features(obs, spec)
    # The row 4 steps ahead of an anchor sees the anchor as lag 4; its targets are the anchor's targets 0/1.
    a = fwd.select(F.col("min_temp_4").alias("cur"), F.col("min_temp").alias("lag4"),
                   F.col("min_temp_target_0").alias("d1"), F.col("min_temp_target_1").alias("d2"))
    b = back.select(F.col("min_temp").alias("cur"), F.col("min_temp_L4").alias("lag4"),
                    F.col("Target_min_temp_D1").alias("d1"), F.col("Target_min_temp_D2").alias("d2"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_random_forest_repeatable(spark):
    train = catalog.split_table(spark, SF_SMALL).filter("split = 'train'")
    t = [REFERENCE_SPEC.target_col("rainfall", 1)]
    m1 = mdl.train_models(train, catalog.FEATURES, t, ("RF",), parallelism=1)
    m2 = mdl.train_models(train.repartition(3), catalog.FEATURES, t, ("RF",), parallelism=1)
    f1 = m1[f"RF_{t[0]}"].stages[-1].featureImportances.toArray()
    f2 = m2[f"RF_{t[0]}"].stages[-1].featureImportances.toArray()
    assert all(math.isclose(x, y) for x, y in zip(f1, f2))
