"""Stage materialisation: cut lineage by writing a table to shared storage.

Downstream plans that use a stage many times (profiles of the split table,
scoring, evaluation) would otherwise re-nest its whole lineage in every
branch; the optimiser then works on a plan that grows with each use. A
written Parquet table in the folder named by ``spark.checkpoint.dir`` (a
shared HDFS/object-store folder on a cluster) is read back with column
pruning and filter pushdown, and survives the loss of any executor.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from meteoframe.session import ensure_checkpoint_dir


_WRITTEN: list[tuple[str, str]] = []  # (label, path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet under the checkpoint folder and return the re-read table."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/stages/{label}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    _WRITTEN.append((label, path))
    return spark.read.parquet(path)


def drop_stages(spark, labels=None) -> int:
    """Delete stage tables written by this process (all, or those with the given labels).

    Only for tables no plan reads any more.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    keep, n = [], 0
    for label, path in _WRITTEN:
        if labels is not None and label not in labels:
            keep.append((label, path))
            continue
        p = jvm.org.apache.hadoop.fs.Path(path)
        n += bool(p.getFileSystem(conf).delete(p, True))
    _WRITTEN[:] = keep
    return n
