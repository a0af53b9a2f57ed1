"""Every plan with a SQL twin equals DuckDB on the same tables (sf0.001)."""

import pytest

from meteoframe.plans.catalog import ORACLE, QUERIES
from tests.compare import compare
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, duck_small, name):
    result = compare(QUERIES[name](spark, SF_SMALL), duck_small, ORACLE[name])
    assert result["columns_match"], (result["spark_columns"], result["oracle_columns"])
    assert result["spark_rows"] == result["oracle_rows"]
    assert result["differing_rows"] == 0, result.get("first_diff")


def test_every_oracle_key_is_a_query():
    assert set(ORACLE) <= set(QUERIES)


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_types_match_duckdb(spark, duck_small, name):
    spark_types = {c: _TYPES.get(t, t) for c, t in QUERIES[name](spark, SF_SMALL).dtypes}
    duck_types = {r[0]: r[1] for r in duck_small.execute(f"describe {ORACLE[name]}").fetchall()}
    assert spark_types == duck_types
