"""Exact top-k by inner product as a Voronoi kNN join.

One more coordinate, sqrt(M^2 - |x|^2) over the greatest norm M, brings all data
to one sphere, where the largest inner product with a query is the smallest
angle to it. Rows belong to the group of their nearest pivot. From the summaries
of the groups (their rows nearest to the pivot) and a bounded sample of rows a
query knows an angle within which k + 1 rows lie; a data row whose angle to its
pivot shows, by the triangle inequality or by the plane between two pivots, that
it lies farther from every query of a group is not sent there. The rest is solved
in blocks of bounded size and merged. Angles only decide what is compared, with
room for rounding; scores are exact integers.

Equal vectors are compared once and carry their least ids, as many as a query
could return.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import map_batches, written
from .member_lloyd import integers

SCALE = 256
#: Bounds of the number of pivots, rows looked at for each, and of query groups; queries of a group, and rows and queries of a block.
MOST_PIVOTS, SAMPLE_PER_PIVOT, MOST_GROUPS = 1024, 8, 256
GROUP_QUERIES, BLOCK_ROWS, BLOCK_QUERIES = 1024, 8192, 2048
#: Room for rounding, in radians.
SLACK = 1e-6


def padded(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a matrix of int64, shorter ones with zeros behind."""
    flat, edge = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    if len(flat) == len(column) * width:
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width), dtype=np.int64)
    row = np.repeat(np.arange(len(column)), np.diff(edge))
    out[row, np.arange(len(flat)) - edge[row]] = flat
    return out


def on_sphere(x: np.ndarray, norm: float) -> np.ndarray:
    """Unit vectors of data rows, one coordinate more."""
    x = x.astype(np.float64)
    return np.column_stack([x, np.sqrt(np.maximum(norm * norm - (x * x).sum(axis=1), 0))]) / norm


def directions(q: np.ndarray) -> np.ndarray:
    """Unit vectors of queries (none is zero), the further coordinate zero."""
    q = q.astype(np.float64)
    return np.column_stack([q / np.sqrt((q * q).sum(axis=1, keepdims=True)), np.zeros(len(q))])


def angles(x: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ to.T, -1, 1))


def pivots(sample: np.ndarray, count: int, rounds: int = 4) -> np.ndarray:
    """``count`` unit vectors amid the unit vectors of ``sample``: a few rounds of spherical k-means."""
    chosen = sample[np.linspace(0, len(sample) - 1, min(count, len(sample))).astype(int)]
    for _ in range(rounds):
        at = (sample @ chosen.T).argmax(axis=1)
        total = np.zeros_like(chosen)
        np.add.at(total, at, sample)
        size = np.sqrt((total * total).sum(axis=1, keepdims=True))
        chosen = np.where(size > 1e-9, total / np.maximum(size, 1e-9), chosen)
    return chosen


def distinct_rows(rows: DataFrame, most: int) -> DataFrame:
    """(rep, v, ids): equal vectors once, with their ``most`` least ids, of which ``rep`` is the first.

    Tasks and salted groups keep no more than that of a vector before all its ids meet.
    """
    nth = F.row_number().over(Window.partitionBy("v", "salt").orderBy("id"))
    some = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(32))).withColumn("nth", nth).filter(F.col("nth") <= most)
    ids = F.slice(F.sort_array(F.collect_list("id")), 1, most)
    return some.groupBy("v").agg(ids.alias("ids")).select(F.element_at("ids", 1).alias("rep"), "v", "ids")


def _grouped(data: DataFrame, centre: np.ndarray, norm: float, width: int) -> DataFrame:
    """(rep, v, ids, cell, angle): data rows with their nearest pivot and the angle to it."""
    shared = data.sparkSession.sparkContext.broadcast(centre)  # MOST_PIVOTS rows at most

    def make():
        centre = shared.value

        def batch(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for k in range(0, b.num_rows, 2048):
                part = b.slice(k, 2048)
                far = angles(on_sphere(padded(part.column(1), width), norm), centre)
                cell = far.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell.astype(np.int32)), pa.array(far[np.arange(len(cell)), cell])], ["rep", "v", "ids", "cell", "angle"])
        return batch

    return map_batches(data.select("rep", "v", "ids"), make, "rep long, v array<long>, ids array<long>, cell int, angle double")


def plane_angles(far: np.ndarray, near: np.ndarray, centre: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """Least angle from each query to the cell of each pivot, by the plane between that pivot and the query's nearest one."""
    to = unit @ centre.T
    own = np.take_along_axis(to, near[:, None], axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * (centre @ centre.T), 0))[near]
    return np.where(apart > 1e-9, np.arcsin(np.clip((own - to) / np.maximum(apart, 1e-9), 0, 1)), 0.0)


def query_bounds(unit: np.ndarray, centre: np.ndarray, inner: np.ndarray, sample: np.ndarray, enough: int, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, low, high) of each query: data rows of cell j between ``low`` and ``high`` from their pivot may be among its ``enough`` nearest.

    ``inner``: angles of the rows nearest to each pivot, ascending, infinite where there are no more.
    """
    far = angles(unit, centre)
    near = far.argmin(axis=1)
    within = [np.minimum(far[:, :, None] + inner[None], np.pi).reshape(len(unit), -1) if np.isfinite(inner).any() else np.zeros((len(unit), 0)), angles(unit, sample)]
    reach = np.full(len(unit), np.pi)
    for some in within:  # bounds of distinct rows in either list; the two lists may share rows, so they are not put together
        if some.shape[1] >= enough:
            reach = np.minimum(reach, np.partition(some, enough - 1, axis=1)[:, enough - 1])
    reach = reach[:, None] + SLACK
    seen = plane_angles(far, near, centre, unit) <= reach
    return (far[:, :groups].argmin(axis=1), np.where(seen, far - reach, np.inf), np.where(seen, far + reach, -np.inf))


def search(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest integer inner products of floor(scale * x) for each row for which ``is_query`` (over ``id``) holds.

    Candidates are all rows but those of the query's own id; ties go to the
    lesser id; a query with fewer candidates gets them all. Null ids and vectors
    that are null or hold null or non-finite components take no part; zero and
    empty vectors do (score 0); shorter vectors count as if zeros followed;
    repeated rows of one id and vector count once, and an id with two vectors
    asks with, and is found by, each. Further columns are ignored; an empty
    table gives an empty result. A ValueError is raised if a score might not fit
    a long.
    """
    plain = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("e")).filter("id is not null")
    rows = written(integers(plain, ["id"], "e", scale).distinct(), "integers")
    data = written(distinct_rows(rows, k + 1), "distinct-vectors")
    length = F.expr("aggregate(v, 0D, (a, x) -> a + double(x) * double(x))")
    n_data, width, square = data.agg(F.count("*"), F.max(F.size("v")), F.max(length)).first()
    empty = rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("score")).filter("false")
    if not n_data:
        return empty
    if square >= 2.0 ** 62:
        raise ValueError("inner products might not fit 64 bits")
    norm = max(float(np.sqrt(square)), 1.0) * (1 + 1e-12)
    queries = rows.filter(is_query).join(data.select(F.col("rep").alias("asker"), "v"), "v").select(F.col("id").alias("query_id"), "asker", "v")
    queries = written(queries, "queries")
    asked = queries.dropDuplicates(["asker"]).select("asker", "v")
    zero = F.expr("forall(v, x -> x = 0)")
    found = _solve(data, written(asked.filter(~zero), "asked"), k + 1, n_data, width, norm, square < 2.0 ** 52)
    least = [r[0] for r in rows.select("id").distinct().orderBy("id").limit(k + 1).collect()]
    if least:  # a zero query scores 0 with every row: the least ids are its nearest
        none = asked.filter(zero).select("asker", F.lit(0).cast("long").alias("score"), F.explode(F.array(*[F.lit(i).cast("long") for i in least])).alias("vec_id"))
        found = found.unionByName(none)
    pairs = queries.select("query_id", "asker").join(found, "asker").filter("vec_id <> query_id")
    pairs = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")) if _repeats(rows) else pairs
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _repeats(rows: DataFrame) -> bool:
    return not rows.groupBy("id").count().filter("count > 1").isEmpty()


def _solve(data: DataFrame, asked: DataFrame, enough: int, n_data: int, width: int, norm: float, small: bool) -> DataFrame:
    """(asker, score, vec_id): at least the ``enough`` best rows of each distinct query vector; none is zero."""
    sc = data.sparkSession.sparkContext
    n_asked = asked.count()
    count = int(min(MOST_PIVOTS, max(1, n_data ** 0.5)))
    some = data.select(F.xxhash64("v").alias("h"), "v").orderBy("h").limit(count * SAMPLE_PER_PIVOT).toArrow()  # 8192 rows at most
    sample = on_sphere(padded(some.column("v").combine_chunks(), width), norm)
    centre = pivots(sample, count)
    cells = written(_grouped(data, centre, norm, width), "cells")
    nth = F.row_number().over(Window.partitionBy("cell").orderBy("angle"))
    inner = np.full((len(centre), enough), np.inf)
    for r in cells.select("cell", "angle").withColumn("nth", nth).filter(F.col("nth") <= enough).collect():  # (k + 1) rows of each pivot
        inner[r["cell"], r["nth"] - 1] = r["angle"]
    groups = int(min(MOST_GROUPS, len(centre), max(1, -(-n_asked // GROUP_QUERIES))))
    known = sc.broadcast((centre, inner, sample))

    def bounds(batches: Iterator[pa.RecordBatch], reduce: bool) -> Iterator[pa.RecordBatch]:
        centre, inner, sample = known.value
        low, high, n = np.full((groups, len(centre)), np.inf), np.full((groups, len(centre)), -np.inf), np.zeros(groups, dtype=np.int64)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                group, least, most = query_bounds(directions(padded(part.column(1), width)), centre, inner, sample, enough, groups)
                if reduce:
                    np.minimum.at(low, group, least)
                    np.maximum.at(high, group, most)
                    n += np.bincount(group, minlength=groups)
                else:
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(group.astype(np.int32))], ["asker", "v", "group"])
        if reduce and n.any():
            there = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(n[there]), pa.array(list(low[there])), pa.array(list(high[there]))], ["group", "n", "low", "high"])

    with_group = written(asked.select("asker", "v").mapInArrow(lambda b: bounds(b, False), "asker long, v array<long>, group int"), "query-groups")
    per_task = asked.select("asker", "v").mapInArrow(lambda b: bounds(b, True), "group int, n long, low array<double>, high array<double>")
    ends = per_task.select("group", "n", F.posexplode(F.arrays_zip("low", "high")).alias("cell", "b")).groupBy("group", "cell").agg(
        F.sum("n").alias("n"), F.min("b.low").alias("low"), F.max("b.high").alias("high"))
    low, high, asks = np.full((groups, len(centre)), np.inf), np.full((groups, len(centre)), -np.inf), np.zeros(groups, dtype=np.int64)
    for r in ends.collect():  # MOST_GROUPS * MOST_PIVOTS rows at most
        low[r["group"], r["cell"]], high[r["group"], r["cell"]], asks[r["group"]] = r["low"], r["high"], r["n"]
    limits = sc.broadcast((low, high))

    def needed(cell: np.ndarray, angle: np.ndarray) -> np.ndarray:
        low, high = limits.value
        return (angle >= low[:, cell]) & (angle <= high[:, cell])  # group, row

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(groups, dtype=np.int64)
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                n += needed(b.column(0).to_numpy()[at:at + 4096], b.column(1).to_numpy()[at:at + 4096]).sum(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(groups, dtype=np.int32)), pa.array(n)], ["group", "n"])

    shares = np.ones(groups, dtype=np.int64)
    for r in cells.select("cell", "angle").mapInArrow(counted, "group int, n long").groupBy("group").agg(F.sum("n").alias("n")).collect():  # a row per group
        shares[r["group"]] = max(1, -(-r["n"] // BLOCK_ROWS))
    asking = np.maximum(1, -(-asks // BLOCK_QUERIES))

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                group, row = np.nonzero(needed(part.column(3).to_numpy(), part.column(4).to_numpy()))
                share = (part.column(0).to_numpy()[row] * np.int64(-7046029254386353131)).view(np.uint64) >> np.uint64(20)
                share = (share % shares[group].astype(np.uint64)).astype(np.int32)
                times = asking[group]
                turn = (np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)).astype(np.int32)
                row, group, share = (np.repeat(x, times) for x in (row, group, share))
                take = pa.array(row)
                for k in range(0, len(row), 4096):
                    s = slice(k, k + 4096)
                    yield pa.RecordBatch.from_arrays([pa.array(group[s].astype(np.int32)), pa.array(share[s]), pa.array(turn[s]), *[part.column(c).take(take.slice(k, 4096)) for c in range(3)]], ["group", "share", "turn", "rep", "v", "ids"])

    blocks = cells.select("rep", "v", "ids", "cell", "angle").mapInArrow(sent, "group int, share int, turn int, rep long, v array<long>, ids array<long>")
    spread = F.create_map(*[x for g in range(groups) for x in (F.lit(g), F.array(F.lit(int(shares[g])), F.lit(int(asking[g]))))])[F.col("group")]  # MOST_GROUPS entries
    turn = F.pmod(F.xxhash64("asker"), F.element_at(spread, 2)).cast("int")
    askers = with_group.select("group", F.explode(F.sequence(F.lit(0), F.element_at(spread, 1) - 1)).alias("share"), turn.alias("turn"), "asker", "v")
    kind = np.float64 if small else np.int64  # products of 2**52 at most are exact in doubles

    def solve(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out = [[], [], []]
        if rows.num_rows and queries.num_rows:
            rows = rows.sort_by("rep")
            x = padded(rows.column("v").combine_chunks(), width).astype(kind)
            q = padded(queries.column("v").combine_chunks(), width).astype(kind)
            n = min(enough, len(x))
            for at in range(0, len(q), 256):
                score = q[at:at + 256] @ x.T
                best = _best(score, n)
                out[0].append(np.repeat(queries.column("asker").to_numpy()[at:at + 256], n))
                out[1].append(np.take_along_axis(score, best, axis=1).ravel().astype(np.int64))
                out[2].append(best.ravel())
        if not out[0]:
            return pa.table({"asker": pa.array([], pa.int64()), "score": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int64()))})
        who, score, best = map(np.concatenate, out)
        return pa.table({"asker": who, "score": score, "ids": rows.column("ids").combine_chunks().take(pa.array(best))})

    keys = ["group", "share", "turn"]
    met = blocks.groupBy(*keys).cogroup(askers.groupBy(*keys)).applyInArrow(solve, "asker long, score long, ids array<long>")
    best = F.row_number().over(Window.partitionBy("asker").orderBy(F.desc("score"), F.element_at("ids", 1)))
    return met.withColumn("nth", best).filter(F.col("nth") <= enough).select("asker", "score", F.explode("ids").alias("vec_id"))


def _best(score: np.ndarray, n: int) -> np.ndarray:
    """Positions of the ``n`` largest of each row, ties to the lesser position, largest first."""
    if score.shape[1] > 4 * n:
        edge = np.partition(score, score.shape[1] - n, axis=1)[:, -n][:, None]
        out = np.zeros((len(score), n), dtype=np.int64)
        for r in range(len(score)):
            at = np.flatnonzero(score[r] >= edge[r])
            out[r] = at[np.argsort(-score[r, at], kind="stable")[:n]]
        return out
    return np.argsort(-score, axis=1, kind="stable")[:, :n]
