"""Imputation equals MLlib Imputer; profile invariants."""

import math

from pyspark.ml.feature import Imputer
from pyspark.sql import functions as F

from meteoframe.operators import impute as imp
from meteoframe.operators import profile as prof
from meteoframe.sources.observations import MEASURES, observations
from tests.conftest import SF_SMALL


def test_impute_mean_equals_mllib_imputer_with_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan")), (4, 4.0)], "k int, x double")
    ours = {r.k: r.x for r in imp.impute_mean(df, ["x"]).collect()}
    theirs = {r.k: r.x for r in Imputer(inputCols=["x"], outputCols=["x"]).fit(df).transform(df).collect()}
    assert ours == theirs == {1: 1.0, 2: 2.5, 3: 2.5, 4: 4.0}


def test_mixed_leaves_no_nulls(spark):
    clean = imp.impute_mixed(observations(spark, SF_SMALL))
    counts = {r.column_name: r.null_count for r in imp.null_counts(clean, MEASURES).collect()}
    assert counts == {m: 0 for m in MEASURES}


def test_null_count_ignores_nan(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (1.0,)], "x double")
    assert imp.null_counts(df, ["x"]).collect()[0].null_count == 1


def test_histogram_counts_sum_to_non_null(spark):
    obs = observations(spark, SF_SMALL)
    h = prof.histogram(obs, MEASURES, 30)
    sums = {r.measure: r.s for r in h.groupBy("measure").agg(F.sum("count").alias("s")).collect()}
    nn = obs.agg(*[F.count(m).alias(m) for m in MEASURES]).collect()[0].asDict()
    assert sums == nn
    assert h.count() == 90


def test_correlation_symmetric_unit_diagonal(spark):
    c = {(r.var_a, r.var_b): r.corr for r in prof.correlation_matrix(observations(spark, SF_SMALL), MEASURES).collect()}
    for a in MEASURES:
        assert math.isclose(c[(a, a)], 1.0)
        for b in MEASURES:
            assert c[(a, b)] == c[(b, a)]


def test_exact_quantiles_equal_percentile(spark):
    obs = observations(spark, SF_SMALL)
    got = {(r.measure, r.p): r.quantile for r in prof.exact_quantiles(obs, MEASURES, (0.1, 0.25, 0.5, 0.9)).collect()}
    ref = obs.agg(*[F.percentile(m, [0.1, 0.25, 0.5, 0.9]).alias(m) for m in MEASURES]).collect()[0]
    for m in MEASURES:
        for p, v in zip((0.1, 0.25, 0.5, 0.9), ref[m]):
            assert math.isclose(got[(m, p)], v, rel_tol=1e-12, abs_tol=1e-12)


def test_statistics_layout(spark):
    stats = prof.advanced_statistics(observations(spark, SF_SMALL), MEASURES)
    wide = prof.statistics_by_row(stats, MEASURES)
    assert sorted(r.statistic for r in wide.collect()) == sorted(prof.STAT_ROWS)
    assert wide.columns == ["statistic", *MEASURES]


def test_one_pass_audit_equals_two_pass(spark):
    obs = observations(spark, SF_SMALL)
    policy = {"min_temp": "mean", "max_temp": "mean", "rainfall": "zero"}
    one = imp.null_audit_filled(obs, policy)
    two = imp.null_audit(obs, imp.impute(obs, policy), MEASURES)
    assert sorted(one.collect()) == sorted(two.collect())
