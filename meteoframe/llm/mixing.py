"""Mixing sources to target weights by cube-method balanced sampling.

Each source has a target of words. A document's expected number of copies is
target / source size (0 to 2); its whole part is given, the fraction is an
inclusion probability. The flight phase of the cube method moves these
probabilities along the null space of the constraints (document total, word
total of the source) until all but two are 0 or 1, so both totals stay exactly
on target. It runs in blocks of a source's documents in parallel; what a block
leaves open (two documents at most) is dealt to blocks of the next round, until
a source has one block. That keeps a few documents of all sizes back, and these
and the last open ones land on whichever outcome is nearest to the totals.

A hot source has more blocks, not larger ones. Blocks and the order inside
them come from hashes of the document, so reruns agree.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import small_side, written

BLOCK = 4096
#: Open documents of all sizes that a source's last block keeps back, so that the landing can reach its word target.
HELD = 10
_EDGE = 1e-9


def flight(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Probabilities after the flight phase: all but at most two are 0 or 1; sum(p) and sum(p * size) are kept.

    Units enter a window of three; the window's two constraints leave one
    direction, along which it moves until a unit of it is decided.
    """
    p = np.clip(p.astype(float), 0, 1)
    scale = max(float(size.max(initial=0)), 1.0)
    x = (size / scale).tolist()
    q = p.tolist()
    window: list[int] = []
    for unit in range(len(q)):
        if _EDGE < q[unit] < 1 - _EDGE:
            window.append(unit)
        else:
            q[unit] = round(q[unit])
        while len(window) == 3:
            a, b, c = window
            # null vector of [[1, 1, 1], [x_a, x_b, x_c]]; equal sizes leave a plane, of which one direction is taken
            u = (x[c] - x[b], x[a] - x[c], x[b] - x[a])
            if max(map(abs, u)) < 1e-15:
                u = (1.0, -1.0, 0.0)
            up = min((1 - q[k]) / v if v > 0 else q[k] / -v for k, v in zip(window, u) if v)
            down = min(q[k] / v if v > 0 else (1 - q[k]) / -v for k, v in zip(window, u) if v)
            step = up if _draw(a, b, c, q[a]) * (up + down) < down else -down
            for k, v in zip(window, u):
                q[k] += step * v
            still = [k for k in window if _EDGE < q[k] < 1 - _EDGE]
            for k in window:
                if k not in still:
                    q[k] = 1.0 if q[k] > 0.5 else 0.0
            if len(still) == 3:  # rounding: the nearest to an edge is decided
                k = min(still, key=lambda j: min(q[j], 1 - q[j]))
                q[k] = float(round(q[k]))
                still.remove(k)
            window = still
    return np.array(q)


def _draw(*seed: float) -> float:
    """A number in [0, 1) that depends on nothing but ``seed``."""
    return (hash(seed) & 0xFFFFFFFF) / 2**32


def land(p: np.ndarray, size: np.ndarray, goal: float) -> np.ndarray:
    """The 0/1 outcome of the last open units (``HELD`` + 2 at most) whose words come nearest to ``goal``, and among near ones the documents to sum(p)."""
    choices = ((np.arange(1 << len(p))[:, None] >> np.arange(len(p))[None, :]) & 1).astype(float)
    unit = max(float(size.mean()) if len(size) else 1.0, 1.0)
    off = np.abs(choices @ size - goal) / unit + 0.02 * np.abs(choices.sum(axis=1) - p.sum())
    return choices[int(np.argmin(off.round(9)))]


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size): sources by code point, null last, have ``weights`` in turn.

    The targets add up to ``share`` times all sizes; one that exceeds ``most``
    times its source's size stops there and the rest is shared by weight again.
    """
    ranked = written(sizes.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
                     .withColumn("at", F.monotonically_increasing_id()), "sources")
    part, before, first = F.shiftright("at", 33), {}, 0
    for r in ranked.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect():  # a row per partition
        before[r["part"]], first = first, first + r["n"]
    if not before:
        return sizes.withColumn("target", F.lit(0.0))
    offset = F.element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]), part)
    index = offset + F.col("at").bitwiseAND((1 << 33) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (index % len(weights) + 1).cast("int"))
    rows = written(ranked.select("source", "source_size", weight.alias("w"), (F.col("source_size") * float(most)).alias("cap")), "weights")
    total = float(rows.agg(F.sum("source_size")).first()[0] or 0) * share
    level = 0.0
    while True:  # words per unit of weight for sources below their cap
        stopped = F.col("cap") <= F.col("w") * level
        r = rows.agg(F.sum(F.when(stopped, F.col("cap"))).alias("used"), F.sum(F.when(~stopped, F.col("w"))).alias("w")).first()
        if not r["w"] or (again := (total - (r["used"] or 0.0)) / r["w"]) <= level * (1 + 1e-12):
            break
        level = again
    return rows.select("source", "source_size", F.when(F.col("cap") <= F.col("w") * level, F.col("cap")).otherwise(F.col("w") * level).alias("target"))


def copies(docs: DataFrame, source_col: str = "source", size_col: str = "size", target_col: str = "target", total_col: str = "source_size", order: list[str] | None = None, block: int = BLOCK) -> DataFrame:
    """``docs`` with a column ``copies``: how often the mix takes each row; ``order`` columns identify a row for hashing.

    Sources of size zero and rows of size zero are not taken.
    """
    order = order or ["doc_id"]
    ratio = F.when(F.col(total_col) > 0, F.col(target_col) / F.col(total_col)).otherwise(F.lit(0.0))
    base = docs.withColumn("_ratio", F.when(F.col(size_col) > 0, ratio).otherwise(0.0)).withColumn("_whole", F.floor(F.col("_ratio") + _EDGE).cast("int")).withColumn(
        "_p", F.greatest(F.col("_ratio") - F.col("_whole"), F.lit(0.0))).withColumn("_hash", F.xxhash64(F.lit("cube"), *order))
    base = base.withColumn("_p", F.when(F.col("_p") < 1e-7, 0.0).when(F.col("_p") > 1 - 1e-7, 1.0).otherwise(F.col("_p")))
    counts = base.filter("_p > 0 and _p < 1").groupBy(source_col).agg(F.count("*").alias("_n"), F.sum(F.col("_p") * F.col(size_col)).alias("_goal"))
    counts = small_side(written(counts.withColumnRenamed(source_col, "_source"), "open"))
    open_ = base.filter("_p > 0 and _p < 1").join(counts, F.col(source_col).eqNullSafe(F.col("_source"))).drop("_source")
    open_ = open_.withColumn("_blocks", F.ceil(F.col("_n") / block).cast("long")).withColumn("_taken", F.lit(0.0))
    closed = [base.filter("_p = 0 or _p = 1")]
    schema = open_.schema
    names = schema.names

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["_hash", size_col, *order], kind="stable").reset_index(drop=True)
        p, size = group["_p"].to_numpy(dtype=float).copy(), group[size_col].to_numpy(dtype=float)
        flown = np.ones(len(p), dtype=bool)
        if group["_blocks"].iloc[0] == 1:
            by_size = np.argsort(size, kind="stable")
            flown[by_size[np.linspace(0, len(p) - 1, min(len(p), HELD)).round().astype(int)]] = False
            flown &= len(p) > HELD + 2
        p[flown] = flight(p[flown], size[flown])
        group["_p"] = p
        return group[names]

    rest = open_
    while True:
        rest = rest.withColumn("_block", F.pmod(F.xxhash64(F.lit("block"), "_hash"), F.col("_blocks")))
        flown = written(rest.groupBy(source_col, "_block").applyInPandas(run, schema), "flight")
        closed.append(flown.filter("_p = 0 or _p = 1").select(*base.columns))
        rest = flown.filter("_p > 0 and _p < 1")
        if rest.filter("_blocks > 1").isEmpty():
            break
        rest = rest.withColumn("_blocks", F.ceil(F.col("_blocks") * 2 / block).cast("long"))
    return _landed(rest, flown_parts=closed, base=base, source_col=source_col, size_col=size_col, order=order, counts=counts, docs=docs)


def _landed(rest: DataFrame, flown_parts: list[DataFrame], base: DataFrame, source_col: str, size_col: str, order: list[str], counts: DataFrame, docs: DataFrame) -> DataFrame:
    """All rows with their copies, the last open ones (HELD + 2 a source at most) landed next to the words that are still missing."""
    taken = flown_parts[1]
    for more in flown_parts[2:]:
        taken = taken.union(more)
    got = taken.filter("_p = 1").groupBy(F.col(source_col).alias("_source")).agg(F.sum(size_col).alias("_got"))
    schema = base.schema
    left = rest.join(small_side(got), F.col(source_col).eqNullSafe(F.col("_source")), "left").withColumn("_left", F.col("_goal") - F.coalesce("_got", F.lit(0)))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["_hash", size_col, *order], kind="stable").reset_index(drop=True)
        group["_p"] = land(group["_p"].to_numpy(), group[size_col].to_numpy(dtype=float), float(group["_left"].iloc[0]))
        return group[schema.names]

    out = flown_parts[0].union(taken).union(left.groupBy(source_col).applyInPandas(run, schema))
    return out.withColumn("copies", (F.col("_whole") + F.col("_p")).cast("int")).select(*docs.columns, "copies")


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, text_key): words of each document (runs of other than ASCII white space; null: 0)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.coalesce(F.expr(r"regexp_count(cast(text as string), '[^\\x20\\x09-\\x0D]+')"), F.lit(0)).cast("long").alias("size"),
                       F.xxhash64(F.col("text").cast("string")).alias("text_key"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(doc_id, source, size, text_key, source_size, target, copies, taken): one row per row of ``docs``.

    ``taken`` is ``copies`` times the document's words, at most twice its size
    for ``most`` = 2. Null texts and empty ones have size 0 and are not taken;
    null sources are one source, the last; an empty table gives no rows;
    repeated rows are drawn one by one; other columns play no part.
    """
    rows = written(sized(docs), "sizes")
    wanted = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    wanted = small_side(written(wanted.withColumnRenamed("source", "_of"), "targets"))
    aimed = rows.join(wanted, F.col("source").eqNullSafe(F.col("_of"))).drop("_of")
    found = copies(aimed, order=["doc_id", "text_key"])
    return found.withColumn("taken", F.col("copies") * F.col("size"))


def mixed(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its copies say, with the columns it had.

    Rows that repeat doc_id and text share their copies evenly.
    """
    key, n = "_mix_key", "_mix_copies"
    drawn = mix(docs, weights, share, most).filter("copies > 0")
    drawn = drawn.groupBy(F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text_key").alias(key)).agg(F.sort_array(F.collect_list("copies"), asc=False).alias(n))
    rows = docs.withColumn(key, F.xxhash64(F.col("doc_id").isNull(), F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string"))))
    once = rows.withColumn("_nth", F.row_number().over(Window.partitionBy(key).orderBy(F.lit(1))))
    return once.join(drawn.select(key, n), key).filter(F.col("_nth") <= F.size(n)).withColumn("_copy", F.explode(F.expr(f"sequence(1, element_at({n}, _nth))"))).select(*[F.col(f"`{c}`") for c in docs.columns])
