"""Product codes by Lloyd's rounds over members that stay where their entry's owner is.

Vectors are integers, cut into equal parts. The members of a codebook entry are
rows of bucketed tables: a row's bucket follows from (position, entry, salt), so
the owner of an entry, or of a salted share of a crowded one, is a bucket. Salts
are dealt evenly by the counted rows, so an entry that holds any share of all
parts is spread over as many owners as its members need.

In a round every owner adds up its resident members without an exchange (Spark
knows the buckets); the sums of an entry's shares, a row each, meet to give the
new codebook, whose size is fixed. Every owner then looks for the nearest entry
of its members: those that keep their entry are written to the bucket they came
from, those that change it, and only those, are shuffled to their new owner.
The final codes come from one pass over the vectors with the frozen codebook.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import discard, map_batches, shared_dir, small_side, written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Members of an entry per salt, members per bucket, and the most buckets Spark allows by default.
SALT_ROWS, BUCKET_ROWS, MOST_BUCKETS = 1 << 16, 1 << 18, 100_000
#: Integers up to here have exact products in doubles; up to LIMIT, in 64-bit integers.
EXACT, LIMIT = 1 << 20, 1 << 24


def integers(vectors: DataFrame, columns: list[str], vector_col: str, scale: int = SCALE) -> DataFrame:
    """``columns`` and ``v``: floor(scale * x) of every component, for rows whose vector is not null and holds only finite components."""
    finite = F.expr("forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    kept = vectors.select(*columns, F.col(vector_col).cast("array<double>").alias("v")).filter("v is not null").filter(finite)
    return kept.withColumn("v", F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x)))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest row of ``book`` for each row of ``x`` (ties to the lower), and the squared distance; exact."""
    at, far = np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=np.int64)
    largest = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
    for k in range(0, len(x), 4096):
        some = x[k:k + 4096]
        if largest <= EXACT and x.shape[1] <= 1024:
            left, right = some.astype(np.float64), book.astype(np.float64)
            away = (right * right).sum(axis=1) - 2 * left @ right.T
            at[k:k + 4096] = away.argmin(axis=1)
        else:
            away = np.stack([((some - c) ** 2).sum(axis=1) for c in book], axis=1)
            at[k:k + 4096] = away.argmin(axis=1)
        far[k:k + 4096] = ((some - book[at[k:k + 4096]]) ** 2).sum(axis=1)
    return at, far


@contextmanager
def _owners_kept(spark: SparkSession):
    """One task per bucket for scans of bucketed tables, while a plan of ours is run."""
    name = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    was = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, was)


class _Members:
    """Bucketed tables of (position, entry, salt, x0, x1, ...), written below the shared folder."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets, self.paths = spark, buckets, {}

    def put(self, rows: DataFrame, split: str | None = None) -> str:
        name = f"llm_members_{uuid.uuid4().hex}"
        path = f"{shared_dir(self.spark).rstrip('/')}/llm-stages/{name}"
        writer = rows.write.format("parquet").bucketBy(self.buckets, "position", "entry", "salt").option("path", path)
        (writer.partitionBy(split) if split else writer).saveAsTable(name)
        self.paths[name] = path
        return name

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")
        discard(self.spark, self.paths.pop(name))


def _dealt(found: DataFrame, width: int, salts: int, members: str) -> DataFrame:
    """(position, entry, salt, x...) of the rows (position, to, x...) of ``found``: running numbers give the salts."""
    columns = [f"x{k}" for k in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId()
        for batch in batches:
            salt = (at + np.arange(batch.num_rows)) % salts
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(salt.astype(np.int32)), *batch.columns[2:]], ["position", "entry", "salt", *columns])

    return found.select("position", "to", *columns).mapInArrow(run, members)


def sums(state: list[DataFrame], width: int) -> DataFrame:
    """(position, entry, n, x...): members and component sums of every entry; owners add up first, without an exchange."""
    columns = [f"x{k}" for k in range(width)]
    own = [t.groupBy("position", "entry", "salt").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in columns]) for t in state]
    every = own[0]
    for more in own[1:]:
        every = every.unionByName(more)
    return every.groupBy("position", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *columns)])


def _updated(book: np.ndarray, totals: DataFrame) -> np.ndarray:
    """The codebook after a round; one row per entry that has members comes to the driver."""
    out = book.copy()
    for r in totals.collect():
        out[r["position"], r["entry"]] = [int(s) // r["n"] for s in r[3:]]
    return out


def train(rows: DataFrame, width: int, n_rows: int, parts: int, entries: int, rounds: int, id_col: str) -> np.ndarray:
    """Codebooks [part, entry, component] of ``rows`` (id, v as integers), after ``rounds`` of Lloyd's algorithm."""
    spark = rows.sparkSession
    first = rows.orderBy(F.col(id_col).asc_nulls_last(), "v").select("v").limit(entries).collect()
    book = np.array([r["v"] for r in first], dtype=np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    if not width or not rounds:
        return book
    salts = -(-n_rows // SALT_ROWS)
    members = _Members(spark, min(MOST_BUCKETS, max(8, -(-n_rows * parts // BUCKET_ROWS))))
    columns = [f"x{k}" for k in range(width)]
    xs = ", ".join(f"{c} long" for c in columns)
    schema = f"position int, entry int, salt int, {xs}"

    def cut(book: np.ndarray) -> DataFrame:
        def make():
            def batch(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
                v = matrix(b.column(0), parts * width)
                for p in range(parts):
                    x = v[:, p * width:(p + 1) * width]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), p, dtype=np.int32)), pa.array(nearest(x, book[p])[0].astype(np.int32)), *[pa.array(np.ascontiguousarray(x[:, k])) for k in range(width)]], ["position", "to", *columns])
            return batch
        return map_batches(rows.select("v"), make, f"position int, to int, {xs}")

    def looked_up(state: list[DataFrame], book: np.ndarray) -> DataFrame:
        def make():
            def batch(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
                position, entry = b.column(0).to_numpy(), b.column(1).to_numpy()
                x = np.stack([b.column(3 + k).to_numpy() for k in range(width)], axis=1)
                to = np.zeros(len(position), dtype=np.int32)
                for p in np.unique(position):
                    here = np.flatnonzero(position == p)
                    to[here] = nearest(x[here], book[p])[0]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(to), pa.array(to == entry)], [*b.schema.names, "to", "stays"])
            return batch
        every = state[0]
        for more in state[1:]:
            every = every.unionByName(more)
        return map_batches(every.select("position", "entry", "salt", *columns), make, f"{schema}, to int, stays boolean")

    with _owners_kept(spark):
        owned = lambda found: _dealt(found, width, salts, schema).repartition(members.buckets, "position", "entry", "salt")
        held = [members.put(owned(cut(book)))]
        state = [spark.table(held[0])]
        book = _updated(book, sums(state, width))
        for _ in range(rounds - 1):
            after = members.put(looked_up(state, book), split="stays")
            moved = members.put(owned(spark.table(after).filter("not stays")))
            for name in held:
                members.drop(name)
            held = [after, moved]
            state = [spark.table(after).filter("stays").select("position", "entry", "salt", *columns), spark.table(moved)]
            book = _updated(book, sums(state, width))
        for name in held:
            members.drop(name)
    return book


def encode(rows: DataFrame, book: np.ndarray, columns: list[str]) -> DataFrame:
    """``columns`` of ``rows`` with ``code`` (hex, two digits a part) and ``error``: nearest entries of the frozen codebooks."""
    shared = rows.sparkSession.sparkContext.broadcast(book)  # parts * entries * width numbers

    def make():
        book = shared.value
        parts, _, width = book.shape

        def batch(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            v = matrix(b.column(len(columns)), parts * width)
            found = [nearest(v[:, p * width:(p + 1) * width], book[p]) for p in range(parts)]
            codes = np.stack([at for at, _ in found], axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([*b.columns[:len(columns)], pa.array([c.tobytes().hex() for c in codes]), pa.array(sum(far for _, far in found))], [*columns, "code", "error"])
        return batch

    kinds = dict(rows.dtypes)
    return map_batches(rows.select(*columns, "v"), make, ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", code string, error long")


def book_hash(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, book.reshape(-1).tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of every row whose vector is not null and has only finite components.

    Codebooks start as the parts of the rows with the ``entries`` (256 at most)
    least ids, null ids last, ties in the order of the vectors; with fewer rows
    there are fewer entries. Repeated rows count one by one; rows without a
    label are one label; further columns are ignored; an empty table gives an
    empty result. Vectors of different lengths, lengths that ``parts`` does not
    divide, and components beyond 2**24 / scale (whose errors would not fit a
    long) raise a ValueError.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    plain = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("e"))
    rows = written(integers(plain, ["id", "label"], "e", scale), "integers")
    n, least, most, largest = rows.agg(F.count("*"), F.min(F.size("v")), F.max(F.size("v")), F.max(F.array_max(F.transform("v", F.abs)))).first()
    names = [F.col("id").alias(id_col), "code", "error", "label_error"]
    if not n:
        empty = rows.select("id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"))
        return empty.select(*names, F.lit("").alias("codebooks_sha256"))
    if least != most or most % parts:
        raise ValueError(f"vectors have {least} to {most} components; one length that {parts} divides is needed")
    if (largest or 0) > LIMIT:
        raise ValueError(f"components beyond {LIMIT / scale} have no exact errors in 64 bits")
    book = train(rows, most // parts, n, parts, entries, rounds, "id")
    coded = written(encode(rows, book, ["id", "label"]), "codes")
    by_label = small_side(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of_label"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of_label"))).select(*names, F.lit(book_hash(book)).alias("codebooks_sha256"))
