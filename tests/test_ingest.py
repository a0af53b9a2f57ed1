"""Tolerant typing of raw text, CSV read with NA, parquet/CSV fallback."""

import datetime as dt

from pyspark.sql import functions as F

from meteoframe.sources import ingest


def _raw_csv(tmp_path):
    text = (
        "Date,Location,MinTemp,MaxTemp,Rainfall\n"
        "2008-12-01,Albury,13.4,22.9,0.6\n"
        "2008-12-02,Albury,NA,25.1,0\n"
        "2008-12-03,Albury,12.9,,abc\n"
        "not-a-date,Albury,9.2,28,0\n"
        "2008-12-01,Sydney,17.5,32.3,1.0\n"
    )
    p = tmp_path / "obs.csv"
    p.write_text(text)
    return str(p)


def test_typed_observations_tolerant(spark, tmp_path):
    cols = [("Date", "date"), ("Location", "string"), ("MinTemp", "double"), ("MaxTemp", "double"), ("Rainfall", "double")]
    raw = ingest.read_observations_csv(spark, _raw_csv(tmp_path), ingest.raw_text_schema(cols))
    typed = ingest.typed_observations(raw, ("Date",), ["MinTemp", "MaxTemp", "Rainfall", "Sunshine"])
    rows = {(r.Location, r.Date): r for r in typed.collect()}
    assert dict(typed.dtypes)["MinTemp"] == "double" and dict(typed.dtypes)["Date"] == "date"
    assert rows[("Albury", dt.date(2008, 12, 2))].MinTemp is None          # NA text
    assert rows[("Albury", dt.date(2008, 12, 3))].MaxTemp is None          # empty field
    assert rows[("Albury", dt.date(2008, 12, 3))].Rainfall is None         # unparsable
    assert rows[("Albury", None)].MinTemp == 9.2                           # bad date -> null date
    assert "Sunshine" not in typed.columns                                 # absent column skipped


def test_load_table_fallback(spark, tmp_path):
    csv_dir = tmp_path / "test_data.csv"
    spark.createDataFrame([(dt.date(2020, 1, 2), 1.0), (dt.date(2020, 1, 1), 2.0)], "Date date, v double") \
        .coalesce(1).write.option("header", True).csv(str(csv_dir))
    df = ingest.load_table(spark, str(tmp_path / "test_data.parquet"), order_by=["Date"])
    assert [r.v for r in df.collect()] == [2.0, 1.0]
    assert ingest.load_table(spark, str(tmp_path / "nothing.parquet")) is None
    pq = tmp_path / "t.parquet"
    ingest.write_parquet(df, str(pq))
    assert ingest.load_table(spark, str(pq)).count() == 2


def test_schema_rows(spark):
    df = spark.range(3).withColumn("x", F.lit(1.5))
    rows = {r.column_name: r.data_type for r in ingest.schema_rows(df).collect()}
    assert rows == {"id": "bigint", "x": "double"}
