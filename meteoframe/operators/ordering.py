"""Order-dependent primitives that never funnel rows through one partition.

All of them deal rows to ranges of the order key, once. The cuts between the
ranges are fixed before the plan is built: a bounded random sample of the key
columns is sorted on the driver, and every so-many-th key becomes a literal of
the plan. So the ranges are a function of the row alone: every branch of a plan,
every retried task and every recomputed partition agrees on them, nothing has
to be checkpointed, and branches that need whole rows share one shuffle.

Inside a range plain window functions do the work (sorting spills to disk).
What crosses the cuts comes from a small table with a few rows per range: sizes
for the row index, totals for the running total, and the first and last rows of
each range for lags and leads. The input is read for a count, for the key sample
and for the rows: write an expensive one first.

Rows with equal keys lie in one range, side by side. Where an operator needs a
total order, neighbours are compared there and the action fails on the first
pair of equal keys; no pass over the data is spent on that.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Keys looked at for each range and at all, rows a range is meant to hold at most, and the most ranges of a plan.
SAMPLE_PER_RANGE, MOST_KEYS, MOST_RANGE_ROWS, MOST_RANGES = 60, 300_000, 1 << 20, 50_000
_RANGE = "_range"


def _key(order_cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order_cols)])


def range_number(df: DataFrame, order_cols: Sequence[str], ranges: int, n: int | None = None) -> Column:
    """Column: the range (0 .. ranges - 1) of a row's key, by a binary search in literal cuts; nulls come first, as in a sort.

    Two small actions over the key columns run here: a count (unless ``n`` is
    given) and a sample of about ``SAMPLE_PER_RANGE`` keys a range, ``MOST_KEYS`` in all.
    """
    n = df.count() if n is None else n
    one = F.pmod(F.hash(*order_cols), F.lit(1))  # always 0; a literal would be taken out of the joins on it
    if ranges < 2 or n < 2:
        return one
    key = _key(order_cols)
    share = min(1.0, min(ranges * SAMPLE_PER_RANGE, MOST_KEYS) / n)
    some = df.select(key.alias("k")) if share == 1.0 else df.select(key.alias("k")).sample(share, seed=42)
    taken = [r[0] for r in some.orderBy("k").select(F.to_json("k")).collect()]  # about MOST_KEYS keys at most
    cuts = [taken[len(taken) * r // ranges] for r in range(1, ranges) if taken]
    cuts = list(dict.fromkeys(cuts))
    if not cuts:
        return one
    kind = StructType([StructField(f"k{i}", df.schema[c].dataType) for i, c in enumerate(order_cols)])
    text = F.lit("[" + ",".join(cuts) + "]")
    bounds = F.sort_array(F.from_json(text, f"array<{kind.simpleString()}>"))  # constant: folded into one literal
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(cuts).bit_length()))])
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) < key, at + step).otherwise(at))
    return F.coalesce(found, F.lit(0))  # never null, which a join need not test before the exchange


def _ranged(df: DataFrame, order_cols: Sequence[str], ranges: int | None, rows: DataFrame | None = None,
            most_rows: int = MOST_RANGE_ROWS, least_rows: int = 1) -> DataFrame:
    """``rows`` (``df`` itself, or ``df`` with other values beside its keys) with ``_range``, one range a partition: the only exchange of whole rows.

    Ranges hold about ``most_rows`` rows at most, and ``least_rows`` at least.

    The condition, always true, names every column: a branch that needs only
    some of them would otherwise get an exchange of its own.
    """
    n = df.count()
    wanted = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(1, min(MOST_RANGES, max(wanted, -(-n // max(most_rows, 1))), n // max(least_rows, 1)))
    dealt = (rows if rows is not None else df).withColumn(_RANGE, range_number(df, order_cols, wanted, n)).repartitionById(wanted, F.col(_RANGE))
    return dealt.filter((F.spark_partition_id() >= 0) | (F.xxhash64(*dealt.columns) == 0))


def _refuse_equal(df: DataFrame, order_cols: Sequence[str], window) -> DataFrame:
    """``df``, whose action fails if two neighbours of ``window`` agree in all ``order_cols``."""
    same = F.lit(True)
    for c in order_cols:
        same = same & F.col(c).eqNullSafe(F.lag(c, 1).over(window))
    first = F.lag(F.lit(True), 1).over(window).isNull()
    shown = F.concat_ws(", ", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("null"))) for c in order_cols])
    text = F.concat(F.lit(f"({', '.join(order_cols)}) is no total order, rows repeat: "), shown, F.lit("; add a unique column to the order"))
    flagged = df.withColumn("_same", ~first & same)
    return flagged.filter(F.when(F.col("_same"), F.raise_error(text).cast("boolean")).otherwise(True)).drop("_same")


def with_row_index(df: DataFrame, order_cols: Sequence[str], index_col: str = "row_idx",
                   num_partitions: int | None = None, unique: bool = True) -> DataFrame:
    """Add ``index_col`` (bigint, 1-based) = position of the row in ``order_cols``.

    With ``unique`` the action fails if two rows agree in all ``order_cols``;
    without, their positions are arbitrary, exactly like ``row_number``.
    """
    ranged = _ranged(df, order_cols, num_partitions)
    within = Window.partitionBy(_RANGE).orderBy(*order_cols)
    numbered = ranged.withColumn("_local", F.row_number().over(within))
    if unique:
        numbered = _refuse_equal(numbered, order_cols, within)
    # One row per range: bounded by the number of ranges, safe to broadcast.
    sizes = ranged.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_RANGE, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    return (numbered.join(F.broadcast(offsets), _RANGE)
            .withColumn(index_col, (F.col("_offset") + F.col("_local")).cast("bigint")).select(*df.columns, index_col))


def _edges(ranged: DataFrame, order_cols: Sequence[str], kept: Sequence[str], lags: int, leads: int) -> DataFrame:
    """(_range, _prev, _next): per range the ``lags`` rows before it, nearest first, and the ``leads`` rows after it.

    Only the first ``leads`` and last ``lags`` rows of the ranges are gathered:
    a few rows per range, bounded by the number of ranges.
    """
    w = Window.partitionBy(_RANGE).orderBy(*order_cols)
    first, last = F.row_number().over(w) <= leads, F.lead(F.lit(True), max(lags, 1)).over(w).isNull()
    ends = ranged.select(_RANGE, _key(order_cols).alias("_k"), F.struct(*kept).alias("_row"), first.alias("_first"), last.alias("_last"))
    marks = ranged.select(_RANGE).distinct()  # stands before the rows of its range
    rows = ends.filter("_first or _last").unionByName(marks, allowMissingColumns=True)
    order = Window.orderBy(_RANGE, "_k")
    # Each range has a last row, and a first one if rows are led: n of them lie within n ranges of at most lags + leads + 1 rows here.
    size = lags + leads + 1
    before = F.collect_list(F.when(F.col("_last"), F.col("_row"))).over(order.rowsBetween(-max(1, lags * size), -1))
    after = F.collect_list(F.when(F.col("_first"), F.struct(_RANGE, "_row"))).over(order.rowsBetween(1, (leads + 1) * size))
    found = rows.select("*", before.alias("_before"), after.alias("_after")).filter("_k is null")
    later = F.filter("_after", lambda x: x[_RANGE] > F.col(_RANGE))
    return found.select(_RANGE, F.slice(F.reverse("_before"), 1, max(lags, 1)).alias("_prev"),
                        F.transform(F.slice(later, 1, max(leads, 1)), lambda x: x["_row"]).alias("_next"))


def shift_columns(df: DataFrame, shifts: Sequence[tuple[str, int, str]], order_cols: Sequence[str],
                  partition_by: Sequence[str] = (), bucket_rows: int = MOST_RANGE_ROWS,
                  index_col: str | None = None, num_partitions: int | None = None, min_bucket_rows: int = 1024,
                  prepare: Callable[[DataFrame], DataFrame] | None = None, unique: bool = True) -> DataFrame:
    """Add lag/lead columns along a total order, optionally per ``partition_by`` key.

    ``shifts`` holds ``(source column, offset, output name)``; a positive
    offset looks back (lag), a negative one looks ahead (lead). Equivalent to
    ``F.lag/F.lead(...).over(Window.partitionBy(*partition_by).orderBy(*order_cols))``.
    Ranges hold about ``bucket_rows`` rows at most, ``min_bucket_rows`` (or ``bucket_rows``) at least. If ``index_col`` is given the
    position in the order (partition key first) is kept under that name.
    ``prepare`` is a row-wise transform keeping the columns (e.g. gap filling).
    With ``unique`` the action fails if two rows agree in all keys.
    """
    lags = max([k for _, k, _ in shifts if k > 0], default=0)
    leads = max([-k for _, k, _ in shifts if k < 0], default=0)
    order = list(dict.fromkeys([*partition_by, *order_cols]))
    rows = prepare(df) if prepare else df
    ranged = _ranged(df, order, num_partitions, rows, bucket_rows, min(min_bucket_rows, bucket_rows))
    series, along = list(partition_by), [c for c in order if c not in partition_by]
    kept = list(dict.fromkeys([*series, *[src for src, _, _ in shifts]]))
    edges = _edges(ranged, order, kept, lags, leads)

    w = Window.partitionBy(_RANGE, *series).orderBy(*along)
    inside = lambda offset: F.lag(F.lit(1), offset).over(w) if offset > 0 else F.lead(F.lit(1), -offset).over(w)
    count = lambda offsets: sum((F.coalesce(inside(k), F.lit(0)) for k in offsets), F.lit(0))
    here = [(F.lag(src, k) if k > 0 else F.lead(src, -k)).over(w).alias(f"_in_{i}") for i, (src, k, _) in enumerate(shifts)]
    found = ranged.select("*", *here, count(range(1, lags + 1)).alias("_back"), count(range(-1, -leads - 1, -1)).alias("_ahead"))
    if unique:
        found = _refuse_equal(found, order, w)
    if index_col:
        found = found.withColumn("_local", F.row_number().over(Window.partitionBy(_RANGE).orderBy(*order)))
        sizes = ranged.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("_rows"))
        before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
        edges = edges.join(sizes.select(_RANGE, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")), _RANGE)
    joined = found.join(F.broadcast(edges), _RANGE)  # a row per range

    def shifted(i: int, src: str, k: int, name: str) -> Column:
        beyond = F.get("_prev", F.lit(k - 1) - F.col("_back")) if k > 0 else F.get("_next", F.lit(-k - 1) - F.col("_ahead"))
        same = F.lit(True)
        for c in series:
            same = same & beyond.getField(c).eqNullSafe(F.col(c))
        in_range = F.col("_back") >= k if k > 0 else F.col("_ahead") >= -k
        return F.when(in_range, F.col(f"_in_{i}")).when(beyond.isNotNull() & same, beyond.getField(src)).alias(name)

    position = [(F.col("_offset") + F.col("_local")).cast("bigint").alias(index_col)] if index_col else []
    return joined.select(*df.columns, *position, *[shifted(i, *s) for i, s in enumerate(shifts)])


def with_running_total(df: DataFrame, order_cols: Sequence[str], weight_col: str, out_col: str = "cum",
                       num_partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` = sum of ``weight_col`` over all rows up to and including this one.

    Same plan shape as ``with_row_index``: ranges with fixed cuts, a running sum
    inside each, and a broadcast table of totals (one row per range).
    """
    ranged = _ranged(df, order_cols, num_partitions)
    within = Window.partitionBy(_RANGE).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumn("_local", F.sum(weight_col).over(within))
    totals = ranged.groupBy(_RANGE).agg(F.sum(weight_col).alias("_tot"))
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(_RANGE, F.coalesce(F.sum("_tot").over(before), F.lit(0)).alias("_offset"))
    return (local.join(F.broadcast(offsets), _RANGE)
            .withColumn(out_col, F.col("_offset") + F.col("_local")).select(*df.columns, out_col))
