"""SQL twins of the named plans, runnable by DuckDB over the driver's tables.

Each text starts from the ``obs`` CTE (the same derivation as
``sources.observations``). Rules that keep Spark and DuckDB bit-identical:
measures are exact binary fractions; averages, sums, lags and exact
quantiles stay unrounded; only stddev/variance/correlation/RMSE/density are
rounded to 6 digits; integer outputs are cast to bigint.
"""

from __future__ import annotations

from meteoframe.functions.columns import poisson1_weight_sql
from meteoframe.sources.observations import OBS_SQL
from meteoframe.spec import REFERENCE_SPEC, FeatureSpec

M = REFERENCE_SPEC.measures


def with_obs(*ctes: str) -> str:
    parts = [f"obs as ({OBS_SQL})"] + list(ctes)
    return "with " + ",\n".join(parts) + "\n"


def mixed_clean_cte(name: str = "clean", src: str = "obs") -> str:
    """M2 in SQL: temperatures by mean, rain by zero."""
    return (
        f"{name} as (select obs_id, station, obs_date, "
        f"coalesce(min_temp, (select avg(min_temp) from {src})) as min_temp, "
        f"coalesce(max_temp, (select avg(max_temp) from {src})) as max_temp, "
        f"coalesce(rainfall, 0.0) as rainfall from {src})"
    )


def mean_clean_cte(name: str = "mclean", src: str = "obs") -> str:
    """M1 in SQL: every measure by its mean."""
    cols = ", ".join(f"coalesce({m}, (select avg({m}) from {src})) as {m}" for m in M)
    return f"{name} as (select obs_id, station, obs_date, {cols} from {src})"


def lag_lead_cte(name: str, src: str, spec: FeatureSpec = REFERENCE_SPEC, complete: bool = True) -> str:
    part = f"partition by {', '.join(spec.partition_by)} " if spec.partition_by else ""
    window = f"over ({part}order by {', '.join(spec.order_cols)})"
    cols = [f"lag({m}, {i}) {window} as {spec.lag_col(m, i)}" for i in range(1, spec.lags + 1) for m in spec.measures]
    cols += [f"lead({m}, {d}) {window} as {spec.target_col(m, d)}" for d in range(1, spec.leads + 1) for m in spec.measures]
    body = f"select obs_id, station, obs_date, {', '.join(spec.measures)}, {', '.join(cols)} from {src}"
    if complete:
        created = [spec.lag_col(m, i) for i in range(1, spec.lags + 1) for m in spec.measures] + spec.target_cols
        cond = " and ".join(f"{c} is not null" for c in ["obs_date", *spec.measures, *created])
        body = f"select * from ({body}) where {cond}"
    return f"{name} as ({body})"


def features_ctes(spec: FeatureSpec = REFERENCE_SPEC) -> list[str]:
    """obs -> M2 -> per-station lag/lead -> complete rows, as CTE ``feat``."""
    return [mixed_clean_cte("clean"), lag_lead_cte("feat", "clean", spec)]


def split_ctes(ratio: float = 0.8) -> list[str]:
    """``feat`` with a train/test tag (first int(n*ratio) rows by date, id), as CTE ``split``."""
    return features_ctes() + [
        "idx as (select *, row_number() over (order by obs_date, obs_id) as _rn from feat)",
        f"cut as (select cast(floor(count(*) * cast({ratio!r} as double)) as bigint) as c from feat)",
        "split as (select idx.* exclude (_rn), case when _rn <= cut.c then 'train' else 'test' end as split from idx, cut)",
    ]


def boundary_ctes(n: int = 100) -> list[str]:
    """Last n train rows + first n test rows of ``split`` as ``boundary`` (with Type)."""
    return split_ctes() + [
        f"boundary as ((select *, 'Train' as Type from split where split = 'train' "
        f"order by obs_date desc, obs_id desc limit {n}) union all "
        f"(select *, 'Test' as Type from split where split = 'test' order by obs_date, obs_id limit {n}))",
        "bpos as (select boundary.*, cast(row_number() over (order by obs_date, obs_id) - 1 as bigint) as pos from boundary)",
    ]


def bootstrap_weight_sql(id_sql: str, run_sql: str) -> str:
    u = (f"(cast(cast(('0x' || substr(md5(cast({id_sql} as varchar) || '-' || cast({run_sql} as varchar)), 1, 8)) as bigint) as double)"
         " / cast(4294967296 as double))")
    return poisson1_weight_sql(u)
