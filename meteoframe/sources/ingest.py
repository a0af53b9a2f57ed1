"""Readers and writers for observation tables and reports.

Paths go through the Hadoop FileSystem of the session, so the same code works
for local paths, HDFS and object stores.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meteoframe.functions.columns import to_date, to_double
from meteoframe.operators.ordering import range_number

# The raw daily-observation layout (name, type), in file order.
RAW_COLUMNS = [
    ("Date", "date"), ("Location", "string"),
    ("MinTemp", "double"), ("MaxTemp", "double"), ("Rainfall", "double"),
    ("Evaporation", "double"), ("Sunshine", "double"),
    ("WindGustDir", "string"), ("WindGustSpeed", "double"),
    ("WindDir9am", "string"), ("WindDir3pm", "string"),
    ("WindSpeed9am", "double"), ("WindSpeed3pm", "double"),
    ("Humidity9am", "double"), ("Humidity3pm", "double"),
    ("Pressure9am", "double"), ("Pressure3pm", "double"),
    ("Cloud9am", "double"), ("Cloud3pm", "double"),
    ("Temp9am", "double"), ("Temp3pm", "double"),
    ("RainToday", "string"), ("RainTomorrow", "string"),
]
RAW_NUMERIC = [n for n, t in RAW_COLUMNS if t == "double"]

# Plain descriptions of the raw columns (used by the data dictionary).
RAW_DESCRIPTIONS = {
    "Date": "Observation date",
    "Location": "Observing station",
    "MinTemp": "Lowest temperature of the day (deg C)",
    "MaxTemp": "Highest temperature of the day (deg C)",
    "Rainfall": "Rain over the day (mm)",
    "Evaporation": "Evaporation over the day (mm)",
    "Sunshine": "Hours of bright sunshine",
    "WindGustDir": "Direction of the strongest gust",
    "WindGustSpeed": "Speed of the strongest gust (km/h)",
    "WindDir9am": "Wind direction at 9am",
    "WindDir3pm": "Wind direction at 3pm",
    "WindSpeed9am": "Wind speed at 9am (km/h)",
    "WindSpeed3pm": "Wind speed at 3pm (km/h)",
    "Humidity9am": "Relative humidity at 9am (%)",
    "Humidity3pm": "Relative humidity at 3pm (%)",
    "Pressure9am": "Air pressure at 9am (hPa)",
    "Pressure3pm": "Air pressure at 3pm (hPa)",
    "Cloud9am": "Cloud cover at 9am (oktas)",
    "Cloud3pm": "Cloud cover at 3pm (oktas)",
    "Temp9am": "Temperature at 9am (deg C)",
    "Temp3pm": "Temperature at 3pm (deg C)",
    "RainToday": "Rain today? (Yes/No)",
    "RainTomorrow": "Rain tomorrow? (Yes/No)",
}


def raw_text_schema(columns: Sequence[tuple[str, str]] = RAW_COLUMNS) -> T.StructType:
    """Every field as text: the file is typed afterwards by ``typed_observations``."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n, _ in columns])


def read_observations_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                          infer: bool = False) -> DataFrame:
    """CSV with a header; ``NA`` means missing. Columns go by their names in the header, in any order.

    Text by default; ``schema`` types the columns it names (unparsable text
    becomes null) and leaves others as text; ``infer`` adds an inference pass.
    """
    reader = spark.read.option("header", True).option("nullValue", "NA").option("mode", "PERMISSIVE")
    if infer:
        return reader.option("inferSchema", True).csv(path)
    text = reader.csv(path)
    kinds = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
    return text.select(*[F.col(f"`{c}`").try_cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in text.columns])


def typed_observations(df: DataFrame, date_cols: Sequence[str] = ("Date",),
                       numeric_cols: Sequence[str] = RAW_NUMERIC, date_format: str | None = None) -> DataFrame:
    """S3/F1/F2: dates and measures typed in one projection, only where present.

    Unparsable text becomes null (``try_to_date`` / ``try_cast``), as the
    non-ANSI casts of older Spark did, instead of failing the job.
    """
    present_dates = set(date_cols) & set(df.columns)
    present_nums = set(numeric_cols) & set(df.columns)
    out = []
    for c in df.columns:
        if c in present_dates:
            out.append(to_date(F.col(c).cast("string"), date_format).alias(c))
        elif c in present_nums:
            out.append(to_double(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def load_table(spark: SparkSession, path: str, order_by: Sequence[str] = ()) -> DataFrame | None:
    """Parquet if it exists, else the CSV next to it, else None."""
    if path_exists(spark, path):
        df = spark.read.parquet(path)
    else:
        folder, _, name = path.rstrip("/").rpartition("/")
        csv = f"{folder}/{name.replace('parquet', 'csv')}" if folder else name.replace("parquet", "csv")
        if not path_exists(spark, csv):
            return None
        df = read_observations_csv(spark, csv, infer=True)
    return df.orderBy(*order_by) if order_by else df


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a Parquet table, optionally partitioned (e.g. by year)."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_by_year(df: DataFrame, path: str, date_col: str = "Date", year_col: str = "year") -> None:
    """One folder per year of ``date_col`` (null dates in one of their own); a task writes to the years it holds."""
    write_parquet(df.withColumn(year_col, F.year(date_col)), path, [year_col])


def read_dates(spark: SparkSession, path: str, first: Column, last: Column, date_col: str = "Date", year_col: str = "year") -> DataFrame:
    """Rows of a table by year whose date lies between ``first`` and ``last``, both included: only the folders of those years are listed and read."""
    df = spark.read.parquet(path)
    return df.filter(F.col(year_col).between(F.year(first), F.year(last)) & F.col(date_col).between(first, last)).drop(year_col)


def write_ordered(df: DataFrame, path: str, order_cols: Sequence[str], files: int | None = None) -> None:
    """Parquet files in the order of ``order_cols``: each holds one range of the keys, sorted, and file numbers ascend with the ranges.

    The table is shuffled once and sorted inside the ranges; no task holds more than its range.
    """
    files = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.withColumn("_range", range_number(df, order_cols, files)).repartitionById(files, F.col("_range"))
    ranged.sortWithinPartitions(*order_cols).drop("_range").write.mode("overwrite").parquet(path)


def read_ordered(spark: SparkSession, path: str, pos_col: str = "pos") -> DataFrame:
    """What :func:`write_ordered` wrote, with the 1-based position of each row in the written order: file number, then row of the file."""
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int")
    placed = spark.read.parquet(path).select("*", part.alias("_part"), F.col("_metadata.row_index").alias("_row"))
    sizes = placed.groupBy("_part").agg((F.max("_row") + 1).alias("_size"))  # a row per file
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.join(F.broadcast(sizes.select("_part", before.alias("_before"))), "_part").withColumn(
        pos_col, F.col("_before") + F.col("_row") + 1).drop("_part", "_row", "_before")


def report_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line) of a written report, header first: its text as it lies in the file. For reports, whose size is bounded."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.posexplode(F.split(F.rtrim(F.col("value"), F.lit("\n")), "\n")).alias("i", "line")).select((F.col("i") + 1).cast("bigint").alias("line_no"), "line")


def read_with_rejects(spark: SparkSession, path: str, kinds: Mapping[str, str], header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) of CSV files whose columns and types are ``kinds`` (name to type, in file order); ``NA`` and empty fields mean missing.

    ``rejects``: (file, reason, column_name, line). A line with too few or too
    many fields is ``malformed`` and not in ``good``. A field that is not
    missing and does not parse as its type is ``unparsable``: null in ``good``,
    and a reject with its column and the line's text. One line can be rejected
    for several columns. Lines are those of the text: a quoted field holds no
    line end. With ``header`` lines that are the header are left out.
    """
    bad = "_corrupt"
    schema = ", ".join(f"`{c}` string" for c in [*kinds, bad])
    options = {"mode": "PERMISSIVE", "nullValue": "NA", "columnNameOfCorruptRecord": bad}
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_name").alias("file")).filter(F.trim("line") != "")
    if header:
        lines = lines.filter(F.col("line") != ",".join(kinds))
    field = lambda c: F.col(f"_r.`{c}`")
    given = lambda c: field(c).isNotNull() & (F.trim(field(c)) != "")
    typed = {c: F.when(given(c), to_date(field(c), None) if k == "date" else field(c).try_cast(k)) for c, k in kinds.items()}
    rows = lines.withColumn("_r", F.from_csv("line", schema, options))
    lost = F.array_compact(F.array(*[F.when(given(c) & typed[c].isNull(), F.lit(c)) for c in kinds]))
    told = lambda reason, column: F.struct(F.lit(reason).alias("reason"), column.alias("column_name"))
    reasons = F.when(field(bad).isNotNull(), F.array(told("malformed", F.lit(None).cast("string")))).otherwise(F.transform(lost, lambda c: told("unparsable", c)))
    rejects = rows.select("file", "line", F.inline(reasons)).select("file", "reason", "column_name", "line")
    return rows.filter(field(bad).isNull()).select(*[typed[c].alias(c) for c in kinds]), rejects


def write_report_csv(df: DataFrame, path: str, order: Sequence[Column] = (), drop: Sequence[str] = ()) -> None:
    """A small report (profile, dictionary, metrics) as one CSV file with header, its rows in ``order``.

    Only for reports whose size is bounded by columns/runs, never for row data.
    """
    one = df.coalesce(1)
    (one.sortWithinPartitions(*order) if order else one).drop(*drop).write.mode("overwrite").option("header", True).csv(path)


def schema_rows(df: DataFrame) -> DataFrame:
    """G1: the schema as rows (name, type, nullable)."""
    spark = df.sparkSession
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return spark.createDataFrame(rows, "column_name string, data_type string, nullable boolean")
