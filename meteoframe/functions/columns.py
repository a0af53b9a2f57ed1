"""Column expressions shared by the operators. All are JVM built-ins."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rain advice thresholds in mm (strictly greater than).
HEAVY_RAIN_MM = 5.0
LIGHT_RAIN_MM = 0.5
ADVICE_HEAVY = "heavy"
ADVICE_LIGHT = "light"
ADVICE_DRY = "dry"

# Display date formats (day/month/year and day/month).
DAY_FORMAT = "dd/MM/yyyy"
SHORT_DAY_FORMAT = "dd/MM"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_double(col: str | Column) -> Column:
    """Text -> double; unparsable text (``NA``, ``abc``) becomes null, not an error."""
    return _c(col).try_cast("double")


def to_date(col: str | Column, fmt: str | None = None) -> Column:
    """Text -> date; an unparsable date becomes null under ANSI mode too."""
    return F.try_to_date(_c(col), F.lit(fmt)) if fmt else F.try_to_date(_c(col))


def without_nan(col: str | Column) -> Column:
    """NaN -> null, so aggregates skip it the way they skip nulls."""
    c = _c(col)
    return F.nanvl(c, F.lit(None).cast("double"))


def rain_advice(pred: str | Column) -> Column:
    """> 5 mm heavy, > 0.5 mm light, else dry; a null prediction stays null."""
    p = _c(pred)
    return (
        F.when(p > HEAVY_RAIN_MM, F.lit(ADVICE_HEAVY))
        .when(p > LIGHT_RAIN_MM, F.lit(ADVICE_LIGHT))
        .when(p.isNotNull(), F.lit(ADVICE_DRY))
    )


def day_label(col: str | Column) -> Column:
    return F.date_format(_c(col), DAY_FORMAT)


def unit_hash(*parts: str | Column) -> Column:
    """Deterministic u in [0, 1) from the first 32 bits of md5 over ``parts`` joined by '-'.

    Depends only on the row's values, never on partitioning, so a resample
    is the same on 1 or 10 000 partitions and after a task retry.
    """
    text = F.concat_ws("-", *[_c(p).cast("string") for p in parts])
    top32 = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return top32.cast("double") / F.lit(float(1 << 32))


def unit_hash52(*parts: str | Column) -> Column:
    """Like :func:`unit_hash`, from the first 52 bits: fine enough to pick one of any number of rows."""
    text = F.concat_ws("-", *[_c(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 52))


def poisson1_cdf(k_max: int = 12) -> list[float]:
    """CDF of Poisson(1) at 0..k_max (computed, not tabulated)."""
    out, acc, term = [], 0.0, math.exp(-1.0)
    for k in range(k_max + 1):
        acc += term
        out.append(acc)
        term /= (k + 1)
    return out


def poisson1_weight(u: Column, k_max: int = 12) -> Column:
    """Inverse-CDF draw of a Poisson(1) count from a uniform ``u``.

    Resampling n rows with replacement is, row by row, a Poisson(1)
    multiplicity; this makes the bootstrap a weighted aggregate with no
    sample materialised and no dependence on the physical layout.
    """
    expr = F.lit(k_max + 1)
    for k, cdf in reversed(list(enumerate(poisson1_cdf(k_max)))):
        expr = F.when(u < F.lit(cdf), F.lit(k)).otherwise(expr)
    return expr.cast("bigint")


def poisson1_weight_sql(u_sql: str, k_max: int = 12) -> str:
    """The same draw as SQL text (for the DuckDB oracle)."""
    arms = " ".join(f"when {u_sql} < cast({cdf!r} as double) then {k}" for k, cdf in enumerate(poisson1_cdf(k_max)))
    return f"(case {arms} else {k_max + 1} end)"


def pearson(a: str | Column, b: str | Column) -> Column:
    """Pearson correlation over rows where both are present; null for a constant input.

    Spark's ``corr`` divides by zero (an error under ANSI) when either side
    is constant, so the ratio is formed with ``try_divide``. The standard
    deviations are taken over the same pairwise-complete rows as the
    covariance.
    """
    x, y = without_nan(a), without_nan(b)
    both = x.isNotNull() & y.isNotNull()
    sx = F.stddev_samp(F.when(both, x))
    sy = F.stddev_samp(F.when(both, y))
    return F.try_divide(F.covar_samp(x, y), sx * sy)
