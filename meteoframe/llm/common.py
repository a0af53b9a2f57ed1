"""Shared helpers: table access, written stages, word coding, size-checked broadcasts.

Everything that cuts lineage is written as Parquet below the cluster's
``spark.checkpoint.dir`` (a folder that driver and executors share), so a lost
executor costs a re-read and never a recomputation of the whole job.
"""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

#: A side with at most this many rows of a few plain columns may be broadcast; more rows take a shuffle join.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; only a local session without that setting gets one of its own."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named
    if not sc.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
    own = tempfile.mkdtemp(prefix="meteoframe-llm-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(own)
    return own


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: computed once, lineage cut."""
    spark = df.sparkSession
    path = path or f"{shared_dir(spark).rstrip('/')}/llm-stages/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its row count, measured here, is at most ``most``; else as it is (shuffle join)."""
    return F.broadcast(df) if df.count() <= most else df


#: What a worker process keeps from one task to the next, by the name of what the tasks share.
_KEPT: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]) -> object:
    """The object of ``make()``, made once in a worker process; tasks that do not share ``name`` let go of it."""
    if name not in _KEPT:
        _KEPT[name] = make()
    return _KEPT[name]


def let_go(but: str | None = None) -> None:
    """Drop what earlier tasks kept in this worker process, ``but`` excepted, and hand freed memory back to the system.

    Spark's workers outlive stages and queries, and an executor's memory has to
    hold all of them at once.
    """
    for name in [n for n in _KEPT if n != but]:
        del _KEPT[name]
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]], schema: str | StructType, keeps: str | None = None) -> DataFrame:
    """``mapInArrow`` with one-off set-up per task: ``make()`` runs in the task and returns the function of a batch.

    ``keeps`` names what the tasks have :func:`kept` for each other; anything else is let go first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(keeps)
        apply = None
        for batch in batches:
            if batch.num_rows:
                apply = apply or make()
                yield from apply(batch)

    return df.mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, text: str = "text", most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """``batch`` cut into slices of about ``most_bytes`` of text (one row at least), so that work space stays bounded."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = np.array([0 if x is None else x for x in pc.binary_length(column).to_pylist()], dtype=np.int64)
    group = np.cumsum(sizes) // most_bytes
    start = 0
    for end in [*(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]:
        if end > start:
            yield batch.slice(start, end - start)
        start = end


class WordCoder(dict):
    """Numbers distinct words in order of appearance; ``describe(word)`` is called once per distinct word.

    Emptied between batches beyond ``most`` words, so that a task's memory does
    not grow with the vocabulary. Numbers are only valid until :meth:`shed`.
    """

    def __init__(self, describe: Callable[[str], object], most: int = 100_000):
        super().__init__()
        self.describe, self.most, self.facts = describe, most, []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self.facts)
        self.facts.append(self.describe(word))
        return number

    def shed(self) -> bool:
        if len(self.facts) > self.most:
            self.clear()
            self.facts.clear()
            return True
        return False

    def code(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))


def discard(spark: SparkSession, path: str) -> None:
    """Delete files that this job wrote at ``path`` and reads no more, in whatever store they are."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
