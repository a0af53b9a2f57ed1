"""The ``obs`` table: dated measurements per station, derived from ``orders``.

The driver ships TPC-H-like tables, not weather files, so the observation
series is a deterministic projection of ``orders`` (one row per order):

* ``obs_id``   – order key, unique, the tie-break of every ordering
* ``station``  – order priority (five stations)
* ``obs_date`` – order date
* three measures that are exact binary fractions (multiples of 1/64 °C or
  1.25 mm), with nulls injected by key residues so every measure has gaps.

The same derivation is given as SQL text (``OBS_SQL``) for the DuckDB oracle.
Only the five needed columns are read, so the Parquet scan prunes the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MEASURES = ("min_temp", "max_temp", "rainfall")

# Fixed derivation of the obs view (must stay identical to OBS_SQL below).
OBS_SQL = """
select o_orderkey                         as obs_id,
       o_orderpriority                    as station,
       cast(o_orderdate as date)          as obs_date,
       case when o_orderkey % 17 <> 0
            then cast(floor(o_totalprice / cast(312.5 as double)) as double) / 64 - 5 end                    as min_temp,
       case when o_orderkey % 19 <> 0
            then cast(floor(o_totalprice / cast(312.5 as double)) as double) / 64 + 3 + o_orderkey % 7 end   as max_temp,
       case when o_orderkey % 23 = 0 then null
            when o_orderkey % 3 <> 0 then cast(0 as double)
            else (o_custkey % 97) * cast(1.25 as double) end                                                 as rainfall
from orders
"""


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _price_step(price: Column) -> Column:
    return F.floor(price / F.lit(312.5)).cast("double") / F.lit(64.0)


def observations_from_orders(orders: DataFrame) -> DataFrame:
    """Project ``orders`` to the obs schema (see module doc)."""
    key = F.col("o_orderkey")
    step = _price_step(F.col("o_totalprice"))
    return orders.select(
        key.alias("obs_id"),
        F.col("o_orderpriority").alias("station"),
        F.col("o_orderdate").cast("date").alias("obs_date"),
        F.when(key % 17 != 0, step - F.lit(5.0)).alias("min_temp"),
        F.when(key % 19 != 0, step + F.lit(3.0) + (key % 7)).alias("max_temp"),
        F.when(key % 23 == 0, F.lit(None).cast("double"))
        .when(key % 3 != 0, F.lit(0.0))
        .otherwise((F.col("o_custkey") % 97) * F.lit(1.25))
        .alias("rainfall"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """obs table for a scale-factor directory of the driver's parquet files."""
    return observations_from_orders(read_table(spark, sf_dir, "orders"))


def raw_text_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """obs as it would arrive in a CSV file: every field is text, gaps are ``NA``.

    Used to drive the tolerant typing operator over data that grows with the
    input tables.
    """
    obs = observations(spark, sf_dir)
    as_text = [
        F.coalesce(F.col(m).cast("string"), F.lit("NA")).alias(m) for m in MEASURES
    ]
    return obs.select(
        F.col("obs_id").cast("string").alias("obs_id"),
        "station",
        F.date_format("obs_date", "yyyy-MM-dd").alias("obs_date"),
        *as_text,
    )
