"""Gap filling: mean, zero or constant per column, and null audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from meteoframe.functions.columns import without_nan


def column_means(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row of means over non-null, non-NaN values (what ``Imputer`` uses)."""
    return df.agg(*[F.avg(without_nan(c)).alias(c) for c in cols])


def _fill_exprs(df: DataFrame, policy: Mapping[str, object], fit_on: DataFrame | None = None) -> dict:
    base = fit_on if fit_on is not None else df
    mean_cols = [c for c, how in policy.items() if how == "mean"]
    means = column_means(base, mean_cols) if mean_cols else None
    out = {}
    for c, how in policy.items():
        if how == "mean":
            fill = means.select(c).scalar()
        elif how == "zero":
            fill = F.lit(0.0)
        else:
            fill = F.lit(float(how))
        out[c] = F.coalesce(without_nan(c), fill)
    return out


def impute(df: DataFrame, policy: Mapping[str, object], fit_on: DataFrame | None = None) -> DataFrame:
    """Fill null and NaN per column: ``"mean"``, ``"zero"`` or a constant.

    Means are scalar subqueries over ``fit_on`` (default ``df``): one partial
    aggregate, folded into the plan as literals, so the row side is never
    joined or shuffled. ``fit_on=train_rows`` avoids the look-ahead of
    computing means on all rows.
    """
    filled = _fill_exprs(df, policy, fit_on)
    return df.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])


def impute_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M1: every listed column filled with its mean."""
    return impute(df, {c: "mean" for c in cols})


def impute_mixed(df: DataFrame, mean_cols: Sequence[str] = ("min_temp", "max_temp"),
                 zero_cols: Sequence[str] = ("rainfall",)) -> DataFrame:
    """M2: temperatures by mean, rain by zero (a missing gauge reading = no rain)."""
    policy: dict[str, object] = {c: "mean" for c in mean_cols}
    policy.update({c: "zero" for c in zero_cols})
    return impute(df, policy)


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, null_count) — nulls only; NaN is not counted."""
    wide = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column_name", "null_count")


def null_audit(before: DataFrame, after: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M3: null counts before and after filling, tagged by ``phase``."""
    return (
        null_counts(before, cols).withColumn("phase", F.lit("before"))
        .unionByName(null_counts(after, cols).withColumn("phase", F.lit("after")))
        .select("phase", "column_name", "null_count")
    )


def null_audit_filled(df: DataFrame, policy: Mapping[str, object]) -> DataFrame:
    """M3 in one pass: null counts of each column as read and after filling with ``policy``."""
    filled = _fill_exprs(df, policy)
    aggs = []
    for c in policy:
        aggs.append(F.count(F.when(F.col(c).isNull(), 1)).alias(f"before|{c}"))
        aggs.append(F.count(F.when(filled[c].isNull(), 1)).alias(f"after|{c}"))
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(phase).alias("phase"), F.lit(c).alias("column_name"),
                     F.col(f"`{phase}|{c}`").alias("null_count"))
            for phase in ("before", "after") for c in policy]
    return wide.select(F.inline(F.array(*rows)))


def write_filled(df: DataFrame, policy: Mapping[str, object], path: str) -> DataFrame:
    """Write ``df`` filled by ``policy`` to ``path``; the M3 audit, counted by the tasks that write.

    (phase, column_name, null_count), a row per phase and column, and
    (``rows``, null, n): the observed metrics of the one pass that fills and
    writes. Means that ``policy`` asks for are subqueries of the same plan; give
    values instead (see :func:`observed_means`) where the input is read once.
    """
    filled = _fill_exprs(df, policy)
    before, after = Observation(), Observation()
    nulls = lambda c: F.count(F.when(F.col(c).isNull(), 1)).alias(c)
    seen = df.select("*", *[filled[c].alias(f"_filled_{c}") for c in policy]).observe(before, F.count(F.lit(1)).alias("rows"), *[nulls(c) for c in policy])
    done = seen.select(*[F.col(f"_filled_{c}").alias(c) if c in policy else F.col(c) for c in df.columns]).observe(after, *[nulls(c) for c in policy])
    done.write.mode("overwrite").parquet(path)
    rows = [(phase, c, o.get[c]) for phase, o in (("before", before), ("after", after)) for c in policy]
    return df.sparkSession.createDataFrame([*rows, ("rows", None, before.get["rows"])], "phase string, column_name string, null_count bigint")


def observed_means(df: DataFrame, cols: Sequence[str], path: str) -> dict[str, float | None]:
    """Write ``df`` to ``path``; the mean of each column, gathered by the pass that writes."""
    seen = Observation()
    df.observe(seen, *[F.avg(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))).alias(c) for c in cols]).write.mode("overwrite").parquet(path)
    return {c: seen.get[c] for c in cols}
