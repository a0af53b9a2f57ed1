"""FeatureSpec: which measures, lags, leads and orderings a series plan uses."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class FeatureSpec:
    """Description of the supervised table built from an observation series.

    ``lags`` are created as ``{m}_L{i}``; ``used_lags`` of them (plus the
    current values when ``include_current``) become model inputs. ``leads``
    are the horizons of the labels ``Target_{m}_D{d}``. Rows are ordered by
    ``order_by`` then ``tie_break`` so that the order is total.
    """

    measures: tuple[str, ...] = ("min_temp", "max_temp", "rainfall")
    lags: int = 5
    used_lags: int = 4
    leads: int = 2
    include_current: bool = True
    partition_by: tuple[str, ...] = ("station",)
    order_by: tuple[str, ...] = ("obs_date",)
    tie_break: tuple[str, ...] = ("obs_id",)
    # Drop incomplete rows on every created column (reference behaviour) or
    # only on the columns that the models use.
    drop_on_all_created: bool = True

    def lag_col(self, m: str, i: int) -> str:
        return f"{m}_L{i}"

    def target_col(self, m: str, d: int) -> str:
        return f"Target_{m}_D{d}"

    @property
    def order_cols(self) -> list[str]:
        return list(self.order_by) + list(self.tie_break)

    @property
    def lag_cols(self) -> list[str]:
        return [self.lag_col(m, i) for i in range(1, self.lags + 1) for m in self.measures]

    @property
    def feature_cols(self) -> list[str]:
        """Model inputs in the reference order: L1 of each measure, ..., then current."""
        cols = [self.lag_col(m, i) for i in range(1, self.used_lags + 1) for m in self.measures]
        if self.include_current:
            cols += list(self.measures)
        return cols

    @property
    def target_cols(self) -> list[str]:
        return [self.target_col(m, d) for d in range(1, self.leads + 1) for m in self.measures]

    def with_(self, **kw) -> "FeatureSpec":
        data = {f: getattr(self, f) for f in self.__dataclass_fields__}
        data.update(kw)
        return FeatureSpec(**data)


# Reference setting: three measures, lags 1..5 created, 1..4 used, current
# values included, labels one and two days ahead.
REFERENCE_SPEC = FeatureSpec()
