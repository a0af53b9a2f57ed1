"""meteoframe — observation-series analytics expressed as Spark DataFrame plans.

Layout:
  sources/    readers and writers (CSV/Parquet/models) and the typed obs view
  functions/  column-level helpers (tolerant casts, advice bands, hashing)
  operators/  DataFrame -> DataFrame operators (profile, impute, series,
              features, models, scoring, evaluation)
  plans/      named query plans over the driver tables and their SQL twins,
              stage materialisation, the end-to-end batch job

Entry points: ``get_session``, ``FeatureSpec``, ``run_batch_job`` and
``scoring_screen`` (lazy imports keep ``import meteoframe`` light).
"""

from meteoframe.spec import REFERENCE_SPEC, FeatureSpec

__all__ = ["FeatureSpec", "REFERENCE_SPEC", "get_session", "run_batch_job", "scoring_screen"]


def __getattr__(name):
    if name == "get_session":
        from meteoframe.session import get_session
        return get_session
    if name in ("run_batch_job", "scoring_screen"):
        from meteoframe.plans import batch_job
        return getattr(batch_job, name)
    raise AttributeError(name)
