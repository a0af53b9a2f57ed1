"""Plans without a SQL twin, checked against brute force on the small fixture."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from meteoframe.functions.columns import poisson1_cdf
from meteoframe.operators import evaluate as ev
from meteoframe.operators import models as mdl
from meteoframe.plans import catalog
from meteoframe.sources.observations import MEASURES, observations
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def models(spark):
    return catalog.trained_models(spark, SF_SMALL)


def test_approx_quantiles_equal_approx_quantile(spark):
    obs = observations(spark, SF_SMALL)
    got = {(r.measure, r.p): r.quantile for r in catalog.QUERIES["approx_quantiles"](spark, SF_SMALL).collect()}
    for m in MEASURES:
        ref = obs.filter(F.col(m).isNotNull()).approxQuantile(m, [0.25, 0.5, 0.75], 0.01)
        assert [got[(m, p)] for p in (0.25, 0.5, 0.75)] == ref


def test_score_table_equals_each_pipeline(spark, models):
    scored = catalog.QUERIES["score_table"](spark, SF_SMALL)
    test = catalog.split_table(spark, SF_SMALL).filter("split = 'test'")
    for key, pm in models.items():
        algo, target = key.split("_", 1)
        alone = pm.transform(test).select("obs_id", F.col("prediction").alias("p"))
        mine = scored.select("obs_id", F.col(ev.pred_col(algo, target)).alias("p"))
        assert alone.exceptAll(mine).count() == 0, key


def _poisson(u: float) -> int:
    for k, c in enumerate(poisson1_cdf()):
        if u < c:
            return k
    return len(poisson1_cdf())


def test_model_bootstrap_report_brute_force(spark, models):
    import hashlib

    test = catalog.split_table(spark, SF_SMALL).filter("split = 'test'")
    from meteoframe.operators import score as sc

    pdf = sc.score_all(test, models).toPandas()
    report = {r.Run_ID: r for r in catalog.QUERIES["model_bootstrap_report"](spark, SF_SMALL).collect()}
    per_run = {}
    for run in range(1, 11):
        w = np.array([_poisson(int(hashlib.md5(f"{k}-{42 + run}".encode()).hexdigest()[:8], 16) / 2**32)
                      for k in pdf["obs_id"]])
        for a in mdl.ALGOS:
            for t in catalog.TARGETS:
                e = pdf[ev.pred_col(a, t)].to_numpy() - pdf[t].to_numpy()
                per_run[(run, a, t)] = math.sqrt((w * e * e).sum() / w.sum())
    for run in range(1, 11):
        for a in mdl.ALGOS:
            for t in catalog.TARGETS:
                assert report[str(run)][f"RMSE_{a}_{t}"] == pytest.approx(per_run[(run, a, t)], abs=1e-6)
    final = report["FINAL_AVERAGE"]
    for a in mdl.ALGOS:
        day1 = np.mean([np.mean([per_run[(r, a, t)] for t in catalog.TARGETS if t.endswith("D1")]) for r in range(1, 11)])
        assert final[f"{a}_Avg_Day1"] == pytest.approx(day1, abs=1e-5)


def test_forecast_card_consistent(spark, models):
    card = catalog.QUERIES["forecast_card"](spark, SF_SMALL).collect()
    for r in card:
        if r.prediction is not None and r.actual is not None:
            assert r.delta == pytest.approx(r.prediction - r.actual)
        if "_rainfall_" in r.target and r.prediction is not None:
            assert r.advice == ("heavy" if r.prediction > 5 else "light" if r.prediction > 0.5 else "dry")
        else:
            assert r.advice is None


def test_boundary_forecast_positions(spark, models):
    rows = catalog.QUERIES["boundary_forecast"](spark, SF_SMALL).select("pos", "Type").collect()
    assert sorted(r.pos for r in rows) == list(range(len(rows)))
    first_test = min(r.pos for r in rows if r.Type == "Test")
    assert all(r.Type == "Train" for r in rows if r.pos < first_test)


def test_sketch_statistics_use_approx_quantile(spark):
    obs = observations(spark, SF_SMALL)
    got = {r.measure: r for r in catalog.QUERIES["advanced_statistics_sketch"](spark, SF_SMALL).collect()}
    for m in MEASURES:
        q1, med, q3 = obs.filter(F.col(m).isNotNull()).approxQuantile(m, [0.25, 0.5, 0.75], 0.01)
        for mine, ref in ((got[m].q1, q1), (got[m].median, med), (got[m].q3, q3)):
            assert mine == pytest.approx(ref, abs=0.0051)  # reported to 2 digits
