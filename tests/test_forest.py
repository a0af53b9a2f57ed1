"""Forests on packed rows: MLlib's trees where nothing is drawn, brute force where rows are drawn, one pass a level for all targets."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from meteoframe.operators import forest, models as mdl
from meteoframe.plans import catalog
from tests.conftest import SF_MID, SF_SMALL

TARGETS = catalog.TARGETS[:3]
NUMBER = re.compile(r"-?\d+\.\d+(?:E-?\d+)?")


@pytest.fixture(scope="module")
def train(spark):
    held = catalog.split_table(spark, SF_SMALL).filter("split = 'train'").persist()
    yield held
    held.unpersist()


def _forests(monkeypatch, rows, packed, **params):
    monkeypatch.setattr(mdl, "PACKED_ROWS", 100 if packed else 1 << 40)
    fitted = mdl.train_models(rows, catalog.FEATURES, TARGETS, ("RF",), params={"RF": params})
    return {t: mdl.regressor_of(fitted[f"RF_{t}"]) for t in TARGETS}


def _tree(model, tree=0):
    """(form, numbers) of a tree's text: features and sides, cuts and predictions."""
    text = model.trees[tree].toDebugString.split("\n", 1)[1]
    return NUMBER.sub("#", text), [float(x) for x in NUMBER.findall(text)]


@pytest.mark.parametrize("params", [dict(), dict(maxDepth=3, maxBins=16, minInstancesPerNode=30)])
def test_a_tree_without_draws_is_mllibs(spark, train, monkeypatch, params):
    whole = dict(numTrees=1, bootstrap=False, featureSubsetStrategy="all", **params)
    ours, theirs = (_forests(monkeypatch, train, packed, **whole) for packed in (True, False))
    for t in TARGETS:
        (form, numbers), (their_form, their_numbers) = _tree(ours[t]), _tree(theirs[t])
        assert form == their_form and "If" in form
        assert numbers == pytest.approx(their_numbers, rel=1e-12, abs=1e-12)
        assert ours[t].featureImportances.toArray() == pytest.approx(theirs[t].featureImportances.toArray(), abs=1e-9)
        assert ours[t].totalNumNodes == theirs[t].totalNumNodes and ours[t].getLabelCol() == t


def test_one_pass_a_level_for_all_targets(spark, train, monkeypatch):
    passes, run = [], forest._level_pass
    monkeypatch.setattr(forest, "_level_pass", lambda *a: (passes.append(a[4]), run(*a))[1])
    models = _forests(monkeypatch, train, True, numTrees=3, maxDepth=3)
    assert passes == [0, 1, 2] and all(m.getNumTrees == 3 for m in models.values())


def test_leaves_are_means_of_the_rows_drawn(spark, train, monkeypatch):
    """Every tree: each leaf predicts the mean of its rows, as often as drawn; the root's cut is the best of its features."""
    target = TARGETS[0]
    model = _forests(monkeypatch, train, True, numTrees=3, maxDepth=2)[target]
    rows = mdl.fit_scaling(train, catalog.FEATURES).transform(train).withColumn("_key", F.xxhash64("obs_id"))
    for tree in range(3):
        out = model.trees[tree].transform(rows).select("_key", "features", target, "prediction").collect()
        y, said = np.array([r[target] for r in out]), np.array([r.prediction for r in out])
        drawn = forest.draws_of_pair(np.array([r._key for r in out]).view(np.uint64), tree // 2, 42, forest.poisson_steps(1.0))[tree % 2]
        assert len(set(said)) == 4
        for value in set(said):
            here = said == value
            assert value == pytest.approx(np.average(y[here], weights=drawn[here]), rel=1e-12)
        x = np.array([r.features.toArray() for r in out])
        root = model.trees[tree]._call_java("rootNode").split()

        def spread(f, at):
            sides = [x[:, f] <= at, x[:, f] > at]
            if any(drawn[s].sum() == 0 for s in sides):
                return np.inf
            return sum((drawn[s] * (y[s] - np.average(y[s], weights=drawn[s])) ** 2).sum() for s in sides)

        best = spread(root.featureIndex(), root.threshold())
        assert all(spread(root.featureIndex(), c) >= best - 1e-6 for c in forest.cuts_of(x[:, root.featureIndex()], 32))


def test_draws_are_poisson_and_of_the_key_alone(spark, train, monkeypatch):
    keys = np.arange(200_000, dtype=np.uint64)
    a, b = forest.draws_of_pair(keys, 0, 42, forest.poisson_steps(1.0))
    for drawn in (a, b):
        share = np.bincount(drawn, minlength=5)[:5] / len(keys)
        assert share == pytest.approx([0.3679, 0.3679, 0.1839, 0.0613, 0.0153], abs=0.004)
    assert abs(np.corrcoef(a, b)[0, 1]) < 0.01
    assert (forest.draws_of_pair(keys[::-1], 0, 42, forest.poisson_steps(1.0))[0] == a[::-1]).all()
    one, other = (_forests(monkeypatch, rows, True, numTrees=4, maxDepth=3) for rows in (train, train.repartition(5, "max_temp")))
    for t in TARGETS:
        for tree in range(4):
            (form, numbers), (other_form, other_numbers) = _tree(one[t], tree), _tree(other[t], tree)
            assert form == other_form and numbers == pytest.approx(other_numbers, rel=1e-12, abs=1e-12)


def test_a_constant_label_or_feature_gives_a_leaf(spark):
    rows = spark.createDataFrame([(i, 1.0, 7.5) for i in range(50)], "obs_id long, x double, y double")
    params = {**mdl.RF_PARAMS, "numTrees": 2}
    scaled = mdl.fit_scaling(rows, ["x"]).transform(rows)
    model = forest.fit_forests(scaled, 50, ["obs_id"], ["y"], "features", params, lambda t: mdl.make_regressor("RF", t, params={"numTrees": 2}))["y"]
    assert model.totalNumNodes == 2 and {r.prediction for r in model.transform(scaled).collect()} == {7.5}


def test_tasks_of_a_pass_grow_with_the_rows():
    tasks = [forest.pass_tasks(n) for n in (0, 1, 1 << 18, (1 << 18) + 1, 43_000_000, 10**9)]
    assert tasks == sorted(tasks) and tasks[:4] == [1, 1, 1, 2] and tasks[4] < 120 and tasks[5] < 400


@pytest.fixture(scope="module")
def packed_queries(spark):
    """The registered queries with forests on packed rows, as over many rows; and the fits made."""
    fits, fit, was, cache = [], forest.fit_forests, mdl.PACKED_ROWS, dict(catalog._MODEL_CACHE)
    catalog._MODEL_CACHE.clear()
    forest.fit_forests, mdl.PACKED_ROWS = lambda *a: (fits.append(list(a[3])), fit(*a))[1], 100
    yield fits
    forest.fit_forests, mdl.PACKED_ROWS = fit, was
    catalog._MODEL_CACHE.clear()
    catalog._MODEL_CACHE.update(cache)


#: Rows of the queries at sf0.01.
QUERY_ROWS = {"train_rf": 96, "forecast_card": 12, "model_bootstrap_report": 11, "score_table": 2993, "forecast_context": 61, "boundary_forecast": 200}


@pytest.mark.parametrize("query", QUERY_ROWS)
def test_queries_take_their_forests_from_one_fit(spark, packed_queries, query):
    rows = catalog.QUERIES[query](spark, SF_MID).collect()
    assert len(rows) == QUERY_ROWS[query]
    assert packed_queries == [catalog.TARGETS]
    if query == "train_rf":
        shares = {t: sum(r.value for r in rows if r.target == t and r.term.startswith("importance")) for t in catalog.TARGETS}
        assert all(s == pytest.approx(1.0) for s in shares.values()) and sum(r.value for r in rows if r.term == "trees") == 600
    if query == "forecast_card":
        assert all(r.model_found and r.prediction is not None for r in rows)
    if query == "score_table":
        for t in catalog.TARGETS:
            actual, said = np.array([r[t] for r in rows]), np.array([r[f"pred_RF__{t}"] for r in rows])
            assert np.sqrt(np.mean((said - actual) ** 2)) < 1.02 * actual.std()
