"""Series operators: roll-ups by date, point and range lookups, lag/lead
features, global row index, chronological split and its boundary views.

Every order-dependent operator goes through ``ordering`` (range partitioning +
halo buckets), so neither a hot station nor the global order collapses the
rows into one task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meteoframe.functions.columns import day_label
from meteoframe.operators.ordering import shift_columns, with_row_index
from meteoframe.spec import REFERENCE_SPEC, FeatureSpec


# --------------------------------------------------------------------------- roll-ups

def national_daily(obs: DataFrame, measures: Sequence[str] = REFERENCE_SPEC.measures,
                   date_col: str = "obs_date") -> DataFrame:
    """One row per date with the average of each measure over all stations.

    Hash aggregate with map-side partial sums, so a date that holds a third
    of the rows costs one partial row per task, not a hot reducer.
    """
    return obs.groupBy(date_col).agg(
        *[F.avg(m).alias(m) for m in measures],
        F.count(F.lit(1)).alias("n_obs"),
    )


def daily_mean_temp(obs: DataFrame, date_col: str = "obs_date") -> DataFrame:
    """Per date, average of (min+max)/2; a row with either missing is skipped."""
    mean = (F.col("min_temp") + F.col("max_temp")) / F.lit(2.0)
    return obs.groupBy(date_col).agg(F.avg(mean).alias("mean_temp"))


def recent_dates(obs: DataFrame, n: int = 50, date_col: str = "obs_date") -> DataFrame:
    """A13 + T1: the latest ``n`` distinct dates, newest first (top-k, no full sort)."""
    return obs.select(date_col).distinct().orderBy(F.col(date_col).desc()).limit(n)


# --------------------------------------------------------------------------- lookups

def _as_date(day: str | dt.date):
    return F.lit(day if isinstance(day, dt.date) else dt.date.fromisoformat(day))


def observation_on_date(df: DataFrame, day: str | dt.date, date_col: str = "obs_date") -> DataFrame:
    """Rows of one date; a date-to-date equality that reaches the scan filter."""
    return df.filter(F.col(date_col) == _as_date(day))


def context_window(df: DataFrame, day: str | dt.date, days: int = 30, date_col: str = "obs_date") -> DataFrame:
    """Rows within ``days`` before and after ``day``, both ends included."""
    d = _as_date(day)
    return df.filter(F.col(date_col).between(F.date_sub(d, days), F.date_add(d, days)))


def complete_cases(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null (or NaN) in any of ``subset`` (default: all columns)."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def one_row_per_date(df: DataFrame, date_col: str = "obs_date",
                     order_cols: Sequence[str] = ("station", "obs_id")) -> DataFrame:
    """The first row of each date by ``order_cols`` (deterministic representative).

    ``min`` over a struct whose leading fields are the order key picks that
    row through a partial aggregate; no per-date window, so a crowded date
    never lands in one task.
    """
    rest = [c for c in df.columns if c != date_col and c not in order_cols]
    packed = F.struct(*[F.col(c) for c in order_cols], *[F.col(c) for c in rest])
    first = df.groupBy(date_col).agg(F.min(packed).alias("_r"))
    return first.select(date_col, *[F.col(f"_r.{c}").alias(c) for c in list(order_cols) + rest]).select(*df.columns)


# --------------------------------------------------------------------------- lag/lead features

def lag_lead_features(df: DataFrame, spec: FeatureSpec = REFERENCE_SPEC, bucket_rows: int = 1 << 20,
                      index_col: str | None = None, drop_incomplete: bool = True,
                      prepare=None) -> DataFrame:
    """Lags 1..spec.lags and leads 1..spec.leads of every measure.

    Per ``spec.partition_by`` (one series per station) or, with an empty
    ``partition_by``, along one global order (the reference's mode). Incomplete
    rows are dropped on all created columns, or only on the model columns when
    ``spec.drop_on_all_created`` is false. ``prepare`` (e.g. gap filling) is
    applied to the rows before they are dealt to ranges. The action fails if two
    rows agree in the whole order key.
    """
    shifts = [(m, i, spec.lag_col(m, i)) for i in range(1, spec.lags + 1) for m in spec.measures]
    shifts += [(m, -d, spec.target_col(m, d)) for d in range(1, spec.leads + 1) for m in spec.measures]
    out = shift_columns(df, shifts, spec.order_cols, spec.partition_by, bucket_rows, index_col=index_col,
                        prepare=prepare)
    if not drop_incomplete:
        return out
    if spec.drop_on_all_created:
        subset = [c for c in out.columns if c != index_col]
    else:
        subset = list(spec.feature_cols) + list(spec.target_cols)
    return complete_cases(out, subset)


def forward_window_features(df: DataFrame, spec: FeatureSpec = REFERENCE_SPEC, window: int = 5,
                            targets: int = 2, bucket_rows: int = 1 << 20, prepare=None) -> DataFrame:
    """Forward-shift table anchored at the oldest day of the window.

    ``{m}_{i}`` = value i rows ahead (i = 1..window-1), ``{m}_target_{j}`` =
    value window+j rows ahead (j = 0..targets-1), incomplete rows dropped.
    """
    shifts = [(m, -i, f"{m}_{i}") for i in range(1, window) for m in spec.measures]
    shifts += [(m, -(window + j), f"{m}_target_{j}") for j in range(targets) for m in spec.measures]
    out = shift_columns(df, shifts, spec.order_cols, spec.partition_by, bucket_rows, prepare=prepare)
    return complete_cases(out)


# --------------------------------------------------------------------------- index and split

def global_row_index(df: DataFrame, order_cols: Sequence[str] = ("obs_date", "obs_id"),
                     index_col: str = "row_idx") -> DataFrame:
    """1-based position of each row in the global order, rows stay distributed."""
    return with_row_index(df, list(order_cols), index_col)


def keys_at_ranks(df: DataFrame, ranks, date_col: str = "obs_date", id_col: str = "obs_id") -> tuple[int, list]:
    """(n, keys): the number of rows, and the key (date, id) of the ``ranks(n)``-th rows (1-based) in (date, id) order; the table is not sorted.

    A per-date histogram (partial aggregate, one row per date: a calendar's
    length) and its running total give n and the dates that hold the ranks; only
    those dates' rows are then ranked by id (in ranges, so even a crowded date is
    spread out). ``ranks`` gives ascending numbers from n. A ValueError is raised
    if the row after a key has the same key.
    """
    hist = df.groupBy(date_col).agg(F.count(F.lit(1)).alias("_cnt")).withColumn("_cum", F.sum("_cnt").over(Window.orderBy(date_col)))
    dates = hist.orderBy(date_col).collect()
    n = dates[-1]["_cum"] if dates else 0
    keys = []
    for rank in ranks(n):
        hit = next(r for r in dates if r["_cum"] >= rank)
        need = rank - (hit["_cum"] - hit["_cnt"])
        day = df.filter(F.col(date_col).eqNullSafe(F.lit(hit[date_col]))).select(id_col)
        ranked = with_row_index(day, [id_col], "_r", unique=False).filter(F.col("_r").isin(need, need + 1))
        near = [r[id_col] for r in ranked.orderBy("_r").collect()]
        if len(near) > 1 and near[0] == near[1]:
            raise ValueError(f"({date_col}, {id_col}) is no total order: the key at the cut repeats; give a unique id column")
        keys.append((hit[date_col], near[0]))
    return n, keys


def key_at_rank(df: DataFrame, rank: int, date_col: str = "obs_date", id_col: str = "obs_id") -> tuple:
    """Key (date, id) of the ``rank``-th row (1-based) in (date, id) order."""
    return keys_at_ranks(df, lambda n: [rank], date_col, id_col)[1][0]


def _up_to(key, date_col: str, id_col: str):
    d, i = key
    return (F.col(date_col) < F.lit(d)) | ((F.col(date_col) == F.lit(d)) & (F.col(id_col) <= F.lit(i)))


def chronological_split(df: DataFrame, train_ratio: float = 0.8, date_col: str = "obs_date",
                        id_col: str = "obs_id", gap: int = 0, split_col: str = "split") -> DataFrame:
    """The first ``int(n * train_ratio)`` rows in (date, id) order are 'train', the rest 'test'.

    The cut is found from a per-date histogram and a rank inside the one cut
    date (``keys_at_ranks``), then applied as a plain comparison with literals
    (pushed down to Parquet where the input is a file), so the table is read for
    two columns and not sorted. ``gap`` rows after the cut are tagged 'gap' so
    that labels of the last training rows (which look ``leads`` rows ahead) do
    not overlap the test rows. Eager: the lookups run here.
    """
    cut = lambda n: int(n * train_ratio)  # truncation, as in the reference
    wanted = lambda n: sorted({k for k in (cut(n), min(n, cut(n) + gap)) if k > 0})
    n, keys = keys_at_ranks(df, wanted, date_col, id_col)
    at = dict(zip(wanted(n), keys))
    up_to = lambda k: _up_to(at[k], date_col, id_col) if k > 0 else F.lit(False)
    k, k_gap = cut(n), min(n, cut(n) + gap)
    tag = F.when(up_to(k), F.lit("train")).when(up_to(k_gap) if k_gap > k else F.lit(False), F.lit("gap")).otherwise(F.lit("test"))
    return df.withColumn(split_col, tag)


def split_boundary_slice(split_df: DataFrame, n: int = 100, order_cols: Sequence[str] = ("obs_date", "obs_id"),
                         split_col: str = "split") -> DataFrame:
    """T2 + U1: last ``n`` training rows and first ``n`` test rows, tagged Train/Test.

    Two top-k selections (each task keeps n rows; the limit is the feature).
    """
    desc = [F.col(c).desc() for c in order_cols]
    tail = split_df.filter(F.col(split_col) == "train").orderBy(*desc).limit(n)
    head = split_df.filter(F.col(split_col) == "test").orderBy(*order_cols).limit(n)
    return tail.withColumn("Type", F.lit("Train")).unionByName(head.withColumn("Type", F.lit("Test")))


def slice_positions(boundary: DataFrame, order_cols: Sequence[str] = ("obs_date", "obs_id"),
                    pos_col: str = "pos") -> DataFrame:
    """0-based position of each row inside the boundary slice.

    The slice holds at most 2n rows (n is the display size), so one window
    partition is bounded by the parameter, not by the data.
    """
    w = Window.orderBy(*order_cols)
    return boundary.withColumn(pos_col, (F.row_number().over(w) - 1).cast("bigint"))


def split_position(boundary: DataFrame) -> DataFrame:
    """Position of the first test row in the slice, and the slice length."""
    with_pos = slice_positions(boundary)
    return with_pos.agg(
        F.min(F.when(F.col("Type") == "Test", F.col("pos"))).alias("split_pos"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def axis_ticks(boundary: DataFrame, ticks: int = 10, date_col: str = "obs_date") -> DataFrame:
    """``ticks`` evenly spaced positions floor(k*(m-1)/(ticks-1)) of the slice, labelled."""
    with_pos = slice_positions(boundary)
    m = with_pos.agg(F.count(F.lit(1))).scalar()
    ks = with_pos.sparkSession.range(ticks).withColumnRenamed("id", "tick")
    wanted = ks.select("tick", F.floor(F.col("tick") * (m - 1) / F.lit(ticks - 1)).cast("bigint").alias("pos"))
    # The slice is at most 2n rows (a limit that is the feature), so this join is small on both sides.
    return wanted.join(with_pos.select("pos", date_col), "pos").select(
        "tick", "pos", date_col, day_label(date_col).alias("label"))


# --------------------------------------------------------------------------- display helpers

def first_rows(df: DataFrame, n: int = 5, order_cols: Sequence[str] = ("obs_date", "obs_id")) -> DataFrame:
    """The first ``n`` rows in a total order (top-k; the limit is the feature)."""
    return df.orderBy(*order_cols).limit(n)
