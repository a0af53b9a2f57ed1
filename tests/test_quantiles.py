"""Exact quantiles, moments and box plots from value ranges: odd distributions against numpy, and the plan's one scan."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from meteoframe.operators import profile as prof
from meteoframe.sources.observations import MEASURES, observations
from tests.conftest import SF_SMALL

RNG = np.random.default_rng(4)
SHAPES = {
    "concentrated": 1013.0 + RNG.normal(size=701),
    "far from zero": 1.7e9 + RNG.normal(size=400),
    "heavy tail": np.exp(RNG.normal(size=500) * 9),
    "both signs": RNG.normal(size=333) * np.exp(RNG.normal(size=333) * 5),
    "mostly zero": np.where(RNG.random(600) < 0.7, 0.0, RNG.random(600)),
    "tiny": RNG.normal(size=90) * 1e-30,
    "two values": np.array([2.0, 7.0]),
    "one value": np.array([5.5]),
    "equal": np.full(64, -3.25),
    "none": np.array([]),
}


@pytest.mark.parametrize("name", SHAPES)
def test_quantiles_and_moments_equal_numpy(spark, name):
    x, probs = SHAPES[name], (0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0)
    rows = [(float(v), 1.0) for v in x] + [(None, None), (float("nan"), 2.0)]
    df = spark.createDataFrame(rows, "a double, b double").repartition(3)
    got = {r["p"]: r["quantile"] for r in prof.exact_quantiles(df, ["a"], probs).collect()}
    assert got == ({p: pytest.approx(np.quantile(x, p), rel=1e-12, abs=1e-300) for p in probs} if len(x) else {})
    r = prof.advanced_statistics(df, ["a", "b"], digits=9).filter("measure = 'a'").first()
    assert r["count"] == len(x)
    if len(x):
        assert r["mean"] == pytest.approx(x.mean(), rel=1e-9, abs=1e-8) and (r["min"], r["max"]) == pytest.approx((x.min(), x.max()), rel=1e-9, abs=1e-8)
    if len(x) > 1:
        assert r["stddev"] == pytest.approx(x.std(ddof=1), rel=1e-5 if name == "far from zero" else 1e-9, abs=1e-8)
    else:
        assert r["stddev"] is None


def test_ranges_ascend_with_the_value(spark):
    x = np.sort(np.concatenate([*SHAPES.values(), np.nextafter(SHAPES["concentrated"], 2000), [0.0, -0.0, 1e308, -1e308]]))
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i int, value double")
    number = [r[0] for r in df.select("i", prof._range_of(F.col("value")).alias("r")).orderBy("i").select("r").collect()]
    assert number == sorted(number) and len(set(number)) > 100


@pytest.mark.parametrize("make", [lambda d: prof.exact_quantiles(d, MEASURES), lambda d: prof.advanced_statistics(d, MEASURES), lambda d: prof.boxplot_stats(d, MEASURES), lambda d: prof.kde_curve(d, MEASURES)])
def test_counts_are_derived_from_one_scan(spark, make):
    df = make(observations(spark, SF_SMALL))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan[:plan.index("== Initial Plan ==")]
    scans = re.findall(r"(ShuffleQueryStage \d+)(?:(?!ShuffleQueryStage|ReusedExchange).)*?FileScan parquet", plan, re.S)
    assert len(set(scans)) == 1 and "ReusedExchange" in plan, plan


def test_rank_window_holds_only_wanted_ranges(spark):
    """Of 200,000 distinct values a window task gets no more than those of two ranges for each probability."""
    df = spark.range(200_000).select((F.col("id") + 1.0).alias("a"))
    counts = prof.value_counts(df, ["a"])
    found = prof._spans(counts)
    widest = found.agg(F.max("t")).first()[0]
    assert widest <= math.ceil(200_000 / prof.RANGES_PER_E) + 1
    assert prof.exact_quantiles(df, ["a"]).orderBy("p").collect()[1]["quantile"] == 100_000.5
