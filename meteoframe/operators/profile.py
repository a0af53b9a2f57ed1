"""Profiles of measures: shape, describe, extended statistics, quantiles,
box-plot fences and outliers, null counts, histograms, density, correlation,
and the data dictionary (A1-A11, A18, G2).

All statistics of all measures come from one aggregate where possible (the
reference ran two jobs per measure). Quantiles are exact by default and
computed without sending a column's values to one task: values are compacted
to (measure, value, count), the counts of value ranges tell which ranges hold
the wanted ranks, and only those are ranked.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meteoframe.functions.columns import pearson, without_nan

QUARTILES = (0.25, 0.5, 0.75)


def long_values(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., measure, value) for non-null, non-NaN values of ``cols``."""
    typed = df.select(*keep, *[without_nan(F.col(c).cast("double")).alias(c) for c in cols])
    return typed.unpivot(list(keep), list(cols), "measure", "value").filter(F.col("value").isNotNull())


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(measure, value, w): the multiset of each measure, compacted (map-side partial counts)."""
    return long_values(df, cols).groupBy("measure", "value").agg(F.count(F.lit(1)).alias("w"))


# --------------------------------------------------------------------------- shape / describe

def table_shape(df: DataFrame) -> DataFrame:
    """A1: (n_rows, n_cols)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("bigint"))


def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(measure, count, mean, stddev, var, min, max): one aggregate over all measures.

    A measure with no values keeps its row (count 0, the rest null).
    """
    aggs = []
    for c in cols:
        v = without_nan(F.col(c).cast("double"))
        aggs += [F.count(v).alias(f"{c}|count"), F.avg(v).alias(f"{c}|mean"), F.stddev_samp(v).alias(f"{c}|stddev"),
                 F.var_samp(v).alias(f"{c}|var"), F.min(v).alias(f"{c}|min"), F.max(v).alias(f"{c}|max")]
    wide = df.agg(*aggs)
    stats = ("count", "mean", "stddev", "var", "min", "max")
    rows = [F.struct(F.lit(c).alias("measure"), *[F.col(f"`{c}|{s}`").alias(s) for s in stats]) for c in cols]
    return wide.select(F.inline(F.array(*rows)))


def describe_measures(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """A2: typed describe — count, mean, stddev (sample), min, max per measure."""
    m = moments(df, cols)
    return m.select("measure", "count", "mean", F.round("stddev", digits).alias("stddev"), "min", "max")


# --------------------------------------------------------------------------- quantiles

#: Value ranges per e-fold of a value, and the unit below which ranges are about equally wide.
RANGES_PER_E, UNIT = 16384.0, 2.0 ** -20


def _range_of(value: Column) -> Column:
    """Number of the value range of ``value``, ascending with it, from the value alone (logarithms are monotone in Java); never null."""
    found = F.signum(value) * F.floor(F.log(F.abs(value) / F.lit(UNIT) + F.lit(1.0)) * F.lit(RANGES_PER_E))
    return F.coalesce(found.cast("bigint"), F.lit(0).cast("bigint"))  # a join need not test it below the exchange of the counts


def _spans(counts: DataFrame) -> DataFrame:
    """Per (measure, range): rows before and in it, and the measure's count, mean, var, min and max.

    One partial aggregate over the counts; what it leaves is a row per value
    range that occurs. Squares are taken around the range's own value, then
    around the mean: a variance is off by 1e-16 * (mean / sd / 16384)^2 of itself at most.
    """
    number = F.col("range")
    centre = F.signum(number) * (F.exp(F.abs(number) / F.lit(RANGES_PER_E)) - F.lit(1.0)) * F.lit(UNIT)
    off, w = F.col("value") - F.col("centre"), F.col("w").cast("double")
    placed = counts.withColumn("range", _range_of(F.col("value"))).withColumn("centre", centre)
    totals = placed.groupBy("measure", "range").agg(F.sum("w").alias("t"), F.max("centre").alias("centre"), F.sum(w * off).alias("d"), F.sum(w * off * off).alias("q"),
                                                    F.min("value").alias("low"), F.max("value").alias("high"))
    all_of, t = Window.partitionBy("measure"), F.col("t").cast("double")
    own = totals.withColumn("m", F.col("centre") + F.col("d") / t).withColumn("count", F.sum("t").over(all_of)).withColumn("before", F.sum("t").over(all_of.orderBy("range")) - F.col("t"))
    own = own.withColumn("mean", F.sum(t * F.col("m")).over(all_of) / F.col("count")).withColumn("min", F.min("low").over(all_of)).withColumn("max", F.max("high").over(all_of))
    squares = F.sum(F.col("q") - F.col("d") * F.col("d") / t + t * (F.col("m") - F.col("mean")) * (F.col("m") - F.col("mean"))).over(all_of)
    return own.select("measure", "range", "before", "t", "count", "mean", F.try_divide(F.greatest(squares, F.lit(0.0)), F.col("count") - 1).alias("var"), "min", "max")


def count_moments(counts: DataFrame) -> DataFrame:
    """(measure, count, mean, stddev, var, min, max) from (measure, value, w)."""
    return _spans(counts).filter("before = 0").select("measure", "count", "mean", F.sqrt("var").alias("stddev"), "var", "min", "max")


def ranked_values(counts: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(measure, count, mean, stddev, var, min, max, quantiles) from (measure, value, w): quantiles in the order of ``probs``.

    Totals per value range come first; only the ranges that hold a wanted rank
    are then sorted and ranked, at most two for each probability. The counts are
    derived once: both steps read the same exchange.
    """
    facts = ["count", "mean", "var", "min", "max"]
    rank = lambda p: (F.floor(F.lit(float(p)) * (F.col("count") - 1)).cast("bigint"), F.ceil(F.lit(float(p)) * (F.col("count") - 1)).cast("bigint"))
    holds = lambda r, first, n: (F.col(first) <= r) & (r < F.col(first) + F.col(n))
    wanted = [r for p in probs for r in rank(p)]
    some = lambda first, n: reduce(or_, [holds(r, first, n) for r in wanted])
    chosen = _spans(counts).filter(some("before", "t")).select("measure", "range", "before", *facts)  # two rows for each measure and probability at most
    within = Window.partitionBy("measure", "range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("range", _range_of(F.col("value"))).join(F.broadcast(chosen), ["measure", "range"])
    ranked = ranked.withColumn("first", F.col("before") + F.sum("w").over(within) - F.col("w")).filter(some("first", "w"))
    at = lambda r: F.max(F.when(holds(r, "first", "w"), F.col("value")))
    ends = [(at(lo).alias(f"lo{i}"), at(hi).alias(f"hi{i}")) for i, (lo, hi) in enumerate(map(rank, probs))]
    found = ranked.groupBy("measure").agg(*[F.max(c).alias(c) for c in facts], *[c for pair in ends for c in pair])
    quantiles = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("count") - 1)
        quantiles.append(F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * (pos - F.floor(pos)))
    return found.select("measure", "count", "mean", F.sqrt("var").alias("stddev"), "var", "min", "max", F.array(*quantiles).alias("quantiles"))


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = QUARTILES,
                    counts: DataFrame | None = None) -> DataFrame:
    """A5: (measure, p, quantile) with linear interpolation between order statistics.

    Position p*(n-1) (0-based), the same definition as Spark ``percentile``
    and SQL ``quantile_cont``; see :func:`ranked_values`.
    """
    picked = ranked_values(counts if counts is not None else value_counts(df, cols), probs)
    pairs = F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("p"), F.col("quantiles").alias("quantile"))
    return picked.select("measure", F.inline(pairs))


def approx_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = QUARTILES,
                     relative_error: float = 0.01) -> DataFrame:
    """A4: Greenwald-Khanna sketch quantiles (``approxQuantile`` semantics), one aggregate."""
    accuracy = max(1, int(round(1.0 / relative_error)))
    long = long_values(df, cols)
    q = long.groupBy("measure").agg(F.percentile_approx("value", list(probs), accuracy).alias("qs"))
    return q.select("measure", F.posexplode("qs").alias("i", "quantile")).select(
        "measure", F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("i") + 1).alias("p"), "quantile")


def _quartiles(counts: DataFrame) -> DataFrame:
    """(measure, count, mean, stddev, var, min, max, q1, median, q3), exact."""
    return ranked_values(counts, QUARTILES).select("measure", "count", "mean", "stddev", "var", "min", "max", *[F.get("quantiles", F.lit(i)).alias(q) for i, q in enumerate(("q1", "median", "q3"))])


def advanced_statistics(df: DataFrame, cols: Sequence[str], digits: int = 2, exact: bool = True) -> DataFrame:
    """A3: count, mean, stddev, var, min, Q1, median, Q3, max, IQR per measure, rounded.

    Moments and quartiles come from the compacted value counts, derived once;
    ``exact=False`` takes them from one aggregate of the rows with sketch
    quartiles as the original report did. A measure without values keeps a row
    of nulls (count 0).
    """
    if exact:
        found = _quartiles(value_counts(df, cols))
    else:
        sketch = approx_quantiles(df, cols, QUARTILES).groupBy("measure").agg(
            *[F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(q) for p, q in zip(QUARTILES, ("q1", "median", "q3"))])
        found = moments(df, cols).join(F.broadcast(sketch), "measure", "left")  # a row per measure
    r = lambda c: F.round(F.col(c), digits).alias(c)
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "measure string")
    return names.join(F.broadcast(found), "measure", "left").select(
        "measure", F.coalesce("count", F.lit(0).cast("bigint")).alias("count"), r("mean"), r("stddev"), r("var"), r("min"), r("q1"), r("median"), r("q3"), r("max"),
        F.round(F.col("q3") - F.col("q1"), digits).alias("iqr"))


STAT_ROWS = ("count", "mean", "stddev", "var", "min", "q1", "median", "q3", "max", "iqr")


def statistics_by_row(stats: DataFrame, measures: Sequence[str]) -> DataFrame:
    """The report layout — one row per statistic, one column per measure."""
    long = stats.select("measure", *[F.col(s).cast("double").alias(s) for s in STAT_ROWS]).unpivot(
        ["measure"], list(STAT_ROWS), "statistic", "value")
    return long.groupBy("statistic").pivot("measure", list(measures)).agg(F.first("value"))


# How the written report names the quartiles.
REPORT_LABELS = {"q1": "25% (Q1)", "median": "50% (Median)", "q3": "75% (Q3)"}


def statistics_text(by_row: DataFrame, measures: Sequence[str]) -> DataFrame:
    """The report as it is written: statistics in their fixed order under their report names, whole numbers without decimals."""
    place = F.array_position(F.array(*map(F.lit, STAT_ROWS)), F.col("statistic"))
    label = F.col("statistic")
    for name, text in REPORT_LABELS.items():
        label = F.when(F.col("statistic") == name, F.lit(text)).otherwise(label)
    shown = [F.when(F.col(m) == F.floor(m), F.col(m).cast("bigint").cast("string")).otherwise(F.col(m).cast("string")).alias(m) for m in measures]
    return by_row.select(place.alias("place"), label.alias("statistic"), *shown)


# --------------------------------------------------------------------------- box plots

def _fences(counts: DataFrame, whisker: float) -> DataFrame:
    """(measure, q1, median, q3, iqr, lower_fence, upper_fence)."""
    spread = F.lit(whisker) * (F.col("q3") - F.col("q1"))
    return _quartiles(counts).select("measure", "q1", "median", "q3", (F.col("q3") - F.col("q1")).alias("iqr"),
                                     (F.col("q1") - spread).alias("lower_fence"), (F.col("q3") + spread).alias("upper_fence"))


def boxplot_stats(df: DataFrame, cols: Sequence[str], whisker: float = 1.5) -> DataFrame:
    """Quartiles, IQR, fences at Q1 - k*IQR / Q3 + k*IQR, whisker ends
    (extreme values inside the fences) and the number of outliers."""
    vc = value_counts(df, cols)
    fences = _fences(vc, whisker)
    # fences: one row per measure; the value side is the compacted counts.
    inside = (F.col("value") >= F.col("lower_fence")) & (F.col("value") <= F.col("upper_fence"))
    return vc.join(F.broadcast(fences), "measure").groupBy(*fences.columns).agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.sum(F.when(~inside, F.col("w")).otherwise(F.lit(0))).cast("bigint").alias("n_outliers"))


def outlier_rows(df: DataFrame, cols: Sequence[str], keep: Sequence[str], whisker: float = 1.5) -> DataFrame:
    """Every (row, measure) whose value lies outside the box-plot fences."""
    fences = _fences(value_counts(df, cols), whisker).select("measure", "lower_fence", "upper_fence")
    long = long_values(df, cols, keep)
    return long.join(F.broadcast(fences), "measure").filter(
        (F.col("value") < F.col("lower_fence")) | (F.col("value") > F.col("upper_fence")))


# --------------------------------------------------------------------------- histogram / density

def histogram(df: DataFrame, cols: Sequence[str], bins: int = 30) -> DataFrame:
    """Equal-width bins over [min, max] per measure, last bin closed, empty bins kept.

    (measure, bin, bin_lo, bin_hi, count, log10_count); ``log10_count`` is the
    log-scale height (null for an empty bin).
    """
    vc = value_counts(df, cols)
    rng = vc.groupBy("measure").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1))).cast("bigint")
    counted = vc.join(F.broadcast(rng), "measure").groupBy("measure", b.alias("bin")).agg(
        F.sum("w").cast("bigint").alias("count"))
    grid = rng.select("measure", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    grid = grid.withColumn("bin", F.col("bin").cast("bigint"))
    return grid.join(counted, ["measure", "bin"], "left").select(
        "measure", "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
        F.round(F.log10(F.col("count")), 6).alias("log10_count"))


# exp(-0.5 z^2) is exactly 0.0 in double precision for |z| > 38.6; beyond this
# many bandwidths a value adds exact zeros, so those grid points are skipped.
_KERNEL_REACH = 40.0


def kde_curve(df: DataFrame, cols: Sequence[str], points: int = 200, digits: int = 6) -> DataFrame:
    """A10: Gaussian kernel density on ``points`` grid points over [min, max].

    Bandwidth = sample sd * n^(-1/5). Exact sum over the compacted values:
    each distinct value contributes w * K(x - v) to the grid points within
    40 bandwidths (all others receive an exact 0.0), generated per value —
    no join of data with data. As n grows the bandwidth shrinks, so a value
    touches a few grid points instead of all of them.
    """
    vc = value_counts(df, cols)
    st = count_moments(vc).select("measure", F.col("count").alias("n"), F.col("min").alias("lo"), F.col("max").alias("hi"), F.col("stddev").alias("sd"))
    st = st.withColumn("bw", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    st = st.withColumn("step", (F.col("hi") - F.col("lo")) / F.lit(float(points - 1)))
    last = F.lit(points - 1)
    reach = F.lit(_KERNEL_REACH) * F.col("bw")
    usable = (F.col("step") > 0) & (F.col("bw") > 0)
    first_pt = F.when(usable, F.greatest(F.lit(0), F.ceil(F.try_divide(F.col("value") - reach - F.col("lo"), F.col("step"))))).otherwise(F.lit(0))
    last_pt = F.when(usable, F.least(last, F.floor(F.try_divide(F.col("value") + reach - F.col("lo"), F.col("step"))))).otherwise(last)
    spread = vc.join(F.broadcast(st), "measure").select(
        "measure", "value", "w", "bw", "lo", "step",
        F.explode(F.sequence(first_pt.cast("int"), last_pt.cast("int"))).alias("point"))
    x = F.col("lo") + F.col("point") * F.col("step")
    z = F.try_divide(x - F.col("value"), F.col("bw"))
    contrib = F.col("w") * F.exp(F.lit(-0.5) * z * z)
    sums = spread.groupBy("measure", "point").agg(F.sum(contrib).alias("s"))
    grid = st.select("measure", "n", "bw", "lo", "step", F.explode(F.sequence(F.lit(0), last)).alias("point"))
    dens = grid.join(sums, ["measure", "point"], "left")
    norm = F.col("n") * F.col("bw") * F.lit((2 * 3.141592653589793) ** 0.5)
    s_all = F.when(F.col("bw") > 0, F.coalesce(F.col("s"), F.lit(0.0)))
    return dens.select("measure", F.col("point").cast("bigint").alias("point"), (F.col("lo") + F.col("point") * F.col("step")).alias("x"),
                       F.round(F.try_divide(s_all, norm), digits).alias("density"))


# --------------------------------------------------------------------------- correlation

def correlation_matrix(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every ordered pair (pairwise-complete rows), one aggregate."""
    pairs = [(a, b) for a in cols for b in cols]
    wide = df.agg(*[pearson(a, b).alias(f"{a}__{b}") for a, b in pairs])
    long = wide.unpivot([], [f"{a}__{b}" for a, b in pairs], "pair", "corr")
    parts = F.split(F.col("pair"), "__")
    return long.select(parts.getItem(0).alias("var_a"), parts.getItem(1).alias("var_b"),
                       F.round("corr", digits).alias("corr"))


# --------------------------------------------------------------------------- dictionary

def data_dictionary(df: DataFrame, descriptions: Mapping[str, str], default: str) -> DataFrame:
    """(column_name, data_type, description) from the schema; unknown columns get ``default``."""
    spark = df.sparkSession
    schema_rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    s = spark.createDataFrame(schema_rows, "column_name string, data_type string")
    d = spark.createDataFrame(list(descriptions.items()), "column_name string, description string")
    # Both sides are bounded by the column count.
    return s.join(F.broadcast(d), "column_name", "left").select(
        "column_name", "data_type", F.coalesce("description", F.lit(default)).alias("description"))


def column_counts(df: DataFrame) -> DataFrame:
    """(column_name, n_rows, n_values) of every column: rows and non-null values, one aggregate over all columns."""
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col("rows").alias("n_rows"), F.col(f"c{i}").alias("n_values")) for i, c in enumerate(df.columns)])))
