"""Models: closed-form ridge equals MLlib, save/load keeps predictions, LR beats persistence on train."""

import pytest
from pyspark.sql import functions as F

from meteoframe.operators import evaluate as ev
from meteoframe.operators import models as mdl
from meteoframe.operators import score as sc
from meteoframe.plans import catalog
from tests.conftest import SF_SMALL


def test_ridge_closed_form_equals_mllib(spark):
    train = catalog.split_table(spark, SF_SMALL).filter("split = 'train'")
    y = catalog.SPEC.target_col("min_temp", 1)
    cf = mdl.ridge_one_lag_closed_form(train, "min_temp", y, 0.1).collect()[0]
    slope, intercept = mdl.ridge_one_lag_mllib(train, "min_temp", y, 0.1)
    assert cf.slope == pytest.approx(slope, rel=1e-9)
    assert cf.intercept == pytest.approx(intercept, rel=1e-9)


@pytest.fixture(scope="module")
def lr_models(spark):
    train = catalog.split_table(spark, SF_SMALL).filter("split = 'train'")
    return mdl.train_models(train, catalog.FEATURES, catalog.TARGETS, ("LR",), parallelism=2)


def test_save_load_same_predictions(spark, lr_models, tmp_path):
    test = catalog.split_table(spark, SF_SMALL).filter("split = 'test'")
    mdl.save_models(lr_models, str(tmp_path / "models"))
    loaded, missing = mdl.load_models(spark, str(tmp_path / "models"), catalog.TARGETS, ("LR", "RF"))
    assert sorted(missing) == sorted(f"RF_{t}" for t in catalog.TARGETS)
    a = sc.score_all(test, lr_models).select("obs_id", *[ev.pred_col("LR", t) for t in catalog.TARGETS])
    b = sc.score_all(test, loaded).select("obs_id", *[ev.pred_col("LR", t) for t in catalog.TARGETS])
    assert a.exceptAll(b).count() == 0
    with pytest.raises(FileNotFoundError):
        mdl.load_models(spark, str(tmp_path / "absent"), catalog.TARGETS)


def test_lr_not_worse_than_persistence_on_train(spark, lr_models):
    train = catalog.split_table(spark, SF_SMALL).filter("split = 'train'")
    scored = ev.persistence_predictions(sc.score_all(train, lr_models))
    r = {(x.algo, x.target): x.rmse for x in ev.rmse_table(scored, ["LR", "LAST"], catalog.TARGETS).collect()}
    for t in catalog.TARGETS:
        assert r[("LR", t)] <= r[("LAST", t)] * 1.01


def test_rain_advice_bands(spark):
    from meteoframe.functions.columns import rain_advice

    df = spark.createDataFrame([(6.0,), (5.0,), (0.6,), (0.5,), (None,)], "p double")
    got = [r.a for r in df.select(rain_advice(F.col("p")).alias("a")).collect()]
    assert got == ["heavy", "light", "light", "dry", None]


def test_score_all_respects_each_preparation(spark, lr_models):
    """A model fitted with another scaler is scored with its own preparation."""
    s = catalog.split_table(spark, SF_SMALL)
    train, test = s.filter("split = 'train'"), s.filter("split = 'test'")
    t = catalog.TARGETS[0]
    other = mdl.train_models(train.filter("obs_date < date'1999-01-01'"), catalog.FEATURES, [t], ("RF",), parallelism=1)
    both = {**{k: v for k, v in lr_models.items() if k.endswith(t)}, **other}
    got = sc.score_all(test, both).select("obs_id", ev.pred_col("RF", t))
    alone = other[f"RF_{t}"].transform(test).select("obs_id", F.col("prediction").alias(ev.pred_col("RF", t)))
    assert got.exceptAll(alone).count() == 0


def test_missing_model_gives_typed_null_and_flag(spark, lr_models):
    test = catalog.split_table(spark, SF_SMALL).filter("split = 'test'").limit(20)
    t = catalog.TARGETS[0]
    scored = sc.score_all(test, lr_models)
    scored = sc.with_missing_predictions(scored, [f"RF_{t}"])
    card = sc.forecast_card(scored, ("LR", "RF"), [t]).collect()
    rf = [r for r in card if r.algo == "RF"]
    lr = [r for r in card if r.algo == "LR"]
    assert rf and all(r.prediction is None and r.delta is None and not r.model_found for r in rf)
    assert lr and all(r.model_found for r in lr)
    assert dict(scored.dtypes)[ev.pred_col("RF", t)] == "double"


def test_forests_over_many_rows_are_fitted_one_at_a_time(spark, monkeypatch):
    """Beyond FOREST_ROWS: one forest at a time, no node numbers, scaled rows on disk only; the trees stay the same."""
    from threading import Lock

    train = catalog.split_table(spark, SF_SMALL).filter("split = 'train'")
    seen, running, lock, make = [], [0], Lock(), mdl.make_regressor

    def made(*args, **kwargs):
        regressor = make(*args, **kwargs)
        fit = regressor.fit

        def watched(vectors):
            with lock:
                running[0] += 1
                seen.append((running[0], regressor.getCacheNodeIds(), vectors.storageLevel.useMemory))
            try:
                return fit(vectors)
            finally:
                with lock:
                    running[0] -= 1

        regressor.fit = watched
        return regressor

    monkeypatch.setattr(mdl, "make_regressor", made)
    few = {"RF": {"numTrees": 3}}
    usual = mdl.train_models(train, catalog.FEATURES, catalog.TARGETS[:3], ("RF",), params=few)
    assert all(cached and not memory for _, cached, memory in seen)
    seen.clear()
    monkeypatch.setattr(mdl, "FOREST_ROWS", 100)
    frugal = mdl.train_models(train, catalog.FEATURES, catalog.TARGETS[:3], ("RF",), params=few)
    assert seen == [(1, False, False)] * 3
    trees = lambda models: {k: [t.toDebugString.split("\n", 1)[1] for t in mdl.regressor_of(m).trees] for k, m in models.items()}
    assert trees(usual) == trees(frugal)
