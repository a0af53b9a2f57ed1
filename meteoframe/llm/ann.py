"""Approximate nearest neighbours by cross-polytope hashing.

Vectors are brought to unit length by one more coordinate, sqrt(M^2 - |x|^2)
over the greatest norm M, which turns the largest inner product into the
nearest direction whatever the norms are. Per table a fast pseudo-random
rotation (three rounds of random signs and a Hadamard transform) is followed by
the nearest signed axis among ``AXES`` coordinates: 2 * AXES cells. Every row is
in one cell per table. A query probes the ``PROBES`` cells whose axes are
nearest to it, in every table; the union of what lies there is reranked exactly
on the original vectors in double precision.

Equal vectors are indexed once, with no more of their ids than a query could
return (the least ones). A cell with many rows is dealt to slices by a hash, and
a query visits each slice, so no task holds a whole hot cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import map_batches, written

TABLES, AXES, PROBES, SLICE_ROWS = 12, 16, 4, 4096


def rotate(x: np.ndarray, table: int, seed: int = 11) -> np.ndarray:
    """Three rounds of random signs and a Hadamard transform, on rows padded to a power of two."""
    d = 1 << max(0, int(x.shape[1] - 1).bit_length())
    out = np.zeros((len(x), d))
    out[:, :x.shape[1]] = x
    signs = np.random.default_rng([seed, table]).choice([-1.0, 1.0], size=(3, d))
    for s in signs:
        out *= s
        h = 1
        while h < d:
            pair = out.reshape(len(x), -1, 2, h)
            out = np.concatenate([pair[:, :, :1] + pair[:, :, 1:], pair[:, :, :1] - pair[:, :, 1:]], axis=2).reshape(len(x), d)
            h *= 2
        out /= np.sqrt(d)
    return out


def cells(x: np.ndarray, table: int, probes: int, axes: int = AXES) -> np.ndarray:
    """[rows, probes]: the cells whose signed axes are nearest to each row, nearest first; cell 2 k is axis +k, 2 k + 1 is -k."""
    y = rotate(x, table)[:, :axes]
    both = np.stack([y, -y], axis=2).reshape(len(x), -1)
    return np.argsort(-both, axis=1, kind="stable")[:, :probes]


def _hashed(rows: DataFrame, norm: float, probes: int, as_query: bool, tables: int, axes: int) -> DataFrame:
    """(cell, id, v): each vector once per table and probed cell."""
    def make():
        def batch(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                x = _matrix(part.column(1))
                extra = np.zeros(len(x)) if as_query else np.sqrt(np.maximum(norm * norm - (x * x).sum(axis=1), 0))
                unit = np.column_stack([x, extra])
                found = np.stack([cells(unit, t, probes, axes) for t in range(tables)])  # table, row, probe
                t, r, p = (k.ravel() for k in np.meshgrid(np.arange(tables), np.arange(len(x)), np.arange(found.shape[2]), indexing="ij"))
                yield pa.RecordBatch.from_arrays([pa.array((t * 2 * axes + found[t, r, p]).astype(np.int32)), part.column(0).take(pa.array(r)), part.column(1).take(pa.array(r))], ["cell", "id", "v"])
        return batch

    return map_batches(rows.select("id", "v"), make, "cell int, id long, v array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): rows with an id whose vector is not null, not empty, not zero, and has only finite components."""
    v = F.col(vector_col).cast("array<double>")
    return vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter("id is not null and v is not null").filter(
        F.expr("size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x <> 0)"))


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
           tables: int = TABLES, axes: int = AXES, probes: int = PROBES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row for which ``is_query`` (a Column over ``id``) holds.

    Largest inner product first, ties to the lesser id; the query's own id is no
    candidate. Vectors that :func:`valid` rejects take no part; vectors of
    another dimension than most queries are compared with their like only;
    repeated rows of one id and vector count once. A query for which the cells
    gave fewer than ``k`` probes all cells of one table, that is every row.
    """
    rows = written(valid(vectors, id_col, vector_col).distinct(), "vectors")
    sizes = [r[0] for r in rows.select(F.size("v")).distinct().limit(65).collect()]
    if len(sizes) > 64:
        raise ValueError("vectors have more than 64 different dimensions")
    parts = [_search(rows.filter(F.size("v") == d), is_query, k, tables, min(axes, 1 << (d).bit_length()), probes) for d in sorted(sizes)]
    if not parts:
        return rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score"))
    out = parts[0]
    for more in parts[1:]:
        out = out.union(more)
    return out


def _search(rows: DataFrame, is_query: Column, k: int, tables: int, axes: int, probes: int) -> DataFrame:
    norm = float(rows.agg(F.max(F.expr("sqrt(aggregate(v, 0D, (a, x) -> a + x * x))"))).first()[0])
    queries = rows.filter(is_query).select("id", "v")
    index = distinct_vectors(rows, k)
    cell_rows = _hashed(index, norm, 1, False, tables, axes)
    found = written(_merge(_rerank(_hashed(queries, norm, probes, True, tables, axes), cell_rows, k), queries, index, k), "neighbours")
    enough = min(k, rows.count() - 1)
    full = found.groupBy("query_id").agg(F.count("*").alias("n")).filter(F.col("n") >= enough)
    short = written(queries.join(full, F.col("id") == F.col("query_id"), "left_anti"), "short-queries")
    if enough <= 0 or short.isEmpty():
        return found
    every = _rerank(_hashed(short, norm, 2 * axes, True, 1, axes), _hashed(index, norm, 1, False, 1, axes), k)
    return found.join(short, F.col("query_id") == F.col("id"), "left_anti").union(_merge(every, short, index, k))


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(id, v, ids): equal vectors once, under their least id, with their ``k`` + 1 least ids (a query can return no more of them).

    Ids are thinned out in salted groups before those of one vector meet.
    """
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(F.lit("salt"), "id"), F.lit(64)))
    least = lambda c: F.slice(F.sort_array(c), 1, k + 1)
    nth = F.row_number().over(Window.partitionBy("v", "salt").orderBy("id"))
    some = salted.withColumn("nth", nth).filter(F.col("nth") <= k + 1)
    return written(some.groupBy("v").agg(least(F.collect_list("id")).alias("ids")).select(F.element_at("ids", 1).alias("id"), "v", "ids"), "distinct-vectors")


def _rerank(asked: DataFrame, indexed: DataFrame, k: int) -> DataFrame:
    """(query_id, rep, score): per query, cell and slice the ``k`` + 1 distinct vectors of largest exact inner product."""
    crowd = indexed.groupBy("cell").agg(F.ceil(F.count("*") / SLICE_ROWS).cast("int").alias("slices"))  # a row per cell
    crowd = F.broadcast(written(crowd, "cells"))
    kept = indexed.join(crowd, "cell").withColumn("slice", F.pmod(F.xxhash64(F.lit("slice"), "id"), F.col("slices")).cast("int")).withColumn("query", F.lit(False))
    visiting = asked.join(crowd, "cell").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).withColumn("query", F.lit(True))
    columns = ["cell", "slice", "query", "id", "v"]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        asking, here = group[group["query"]], group[~group["query"]].sort_values("id")
        out = {"query_id": np.zeros(0, np.int64), "rep": np.zeros(0, np.int64), "score": np.zeros(0)}
        if len(asking) and len(here):
            x, ids = np.stack(here["v"].to_numpy()), here["id"].to_numpy(np.int64)
            q, who = np.stack(asking["v"].to_numpy()), asking["id"].to_numpy(np.int64)
            parts = []
            for at in range(0, len(q), 256):
                score = np.einsum("qd,nd->qn", q[at:at + 256], x, optimize=True)
                n = min(k + 1, len(ids))
                best = np.argsort(-score, axis=1, kind="stable")[:, :n] if len(ids) <= 4 * n else _top(score, n)
                parts.append((np.repeat(who[at:at + 256], n), ids[best].ravel(), np.take_along_axis(score, best, axis=1).ravel()))
            out = dict(zip(out, map(np.concatenate, zip(*parts))))
        return pd.DataFrame(out)

    return kept.select(columns).union(visiting.select(columns)).groupBy("cell", "slice").applyInPandas(run, "query_id long, rep long, score double")


def _top(score: np.ndarray, n: int) -> np.ndarray:
    """Positions of the ``n`` largest of each row, ties at the edge to the lesser position."""
    edge = -np.partition(-score, n - 1, axis=1)[:, n - 1:n]
    order = np.where(score > edge, 0, np.where(score == edge, 1, 2))
    return np.argsort(order, axis=1, kind="stable")[:, :n]


def _merge(found: DataFrame, queries: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of what the cells gave, classes of equal vectors written out."""
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "rep")
    # a class that k + 1 others precede has k candidates before it even if one of them is the query itself
    best = found.groupBy("query_id", "rep").agg(F.max("score").alias("score")).withColumn("nth", F.row_number().over(nearest)).filter(F.col("nth") <= k + 1)
    full = best.select("query_id", "rep").join(queries.select(F.col("id").alias("query_id"), F.col("v").alias("q")), "query_id").join(
        index.select(F.col("id").alias("rep"), "v", "ids"), "rep")
    exact = F.expr("aggregate(zip_with(q, v, (x, y) -> x * y), 0D, (a, x) -> a + x)")
    rows = full.select("query_id", exact.alias("score"), F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
