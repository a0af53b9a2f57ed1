"""Constant and all-null measures under ANSI mode: no division errors, rows kept."""

from meteoframe.functions.columns import pearson
from meteoframe.operators import profile as prof


def _frame(spark):
    return spark.createDataFrame([(1, 2.0, None), (2, 2.0, None), (3, 2.0, None)], "k int, c double, z double")


def test_profiles_on_constant_and_empty_columns(spark):
    df = _frame(spark)
    stats = {r.measure: r for r in prof.advanced_statistics(df, ["c", "z"]).collect()}
    assert stats["c"].stddev == 0.0 and stats["c"].iqr == 0.0
    assert stats["z"]["count"] == 0 and stats["z"].mean is None
    hist = prof.histogram(df, ["c"], 5).collect()
    assert sum(r["count"] for r in hist) == 3
    assert all(r.density is None for r in prof.kde_curve(df, ["c"], 5).collect())
    assert all(r.corr is None for r in prof.correlation_matrix(df, ["c", "z"]).collect())


def test_pearson_pairwise_complete(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (None, 1.0), (4.0, 8.0)], "a double, b double")
    assert abs(df.agg(pearson("a", "b").alias("r")).collect()[0].r - 1.0) < 1e-12
