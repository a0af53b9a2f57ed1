"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most ``2 r`` bits apart have a common variant at most ``r``
bits from either. Every distinct fingerprint therefore emits all variants
within ``r`` bits (2,081 for r = 2), rows are shuffled on variants, and
fingerprints that meet on a variant are deduplicated, verified and linked.

The shuffle key is a prefix of the variant. All variants of a fingerprint that
share a prefix travel as ONE row (prefix, fingerprint), and the receiving task
writes them out: 37 rows instead of 2,081 for an 8-bit prefix. Which prefixes
a fingerprint reaches and which variants it has there follows from the bits
alone, so the set of meeting pairs is the full one. Prefixes that gather too
many fingerprints are split by further bits, in the same manner, before any
task receives them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import map_batches, written
from .components import components

#: A bit of each byte lane: eight counters in one word, good for 255 additions.
_LANES = np.uint64(0x0101010101010101)


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of ``hashes`` have each bit set, lowest bit first."""
    counts = np.zeros(64, dtype=np.int64)
    n = len(hashes)
    padded = np.zeros(-(-n // 255) * 255, dtype=np.uint64)
    padded[:n] = hashes
    rows = padded.reshape(-1, 255)
    for j in range(8):
        lanes = ((rows >> np.uint64(j)) & _LANES).sum(axis=1, dtype=np.uint64)
        counts[j::8] = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts


def fingerprint(text: str | None, shingle: int = 4, block: int = 1 << 16) -> int:
    """SimHash of the word shingles of ``text`` (A-Z lower-cased, words split at ASCII white space, repeats counted).

    Fewer words than ``shingle``: the whole sequence is one shingle. No word or null: 0.
    Shingles are hashed with XXH64, seed 42; a bit is set if it is set in more than half of them.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined, hashed = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return hashed(joined, 42)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[: len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist()
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, len(starts), block):
        counts += _bit_counts(np.array([hashed(joined[s:e], 42) for s, e in zip(starts[k:k + block], ends[k:k + block])], dtype=np.uint64))
    return int(sum(1 << j for j in np.flatnonzero(2 * counts > len(starts)).tolist()))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(doc_id, row_key, fp): one row per row of ``docs``; fp is the fingerprint as a signed 64-bit number, row_key a hash of id and text."""

    def make():
        def batch(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            found = np.fromiter((fingerprint(x.as_py(), shingle) for x in rows.column(2)), dtype=np.uint64, count=rows.num_rows)
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(found.view(np.int64))], ["doc_id", "row_key", "fp"])
        return batch

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), _row_key(id_col, text_col).alias("row_key"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, make, "doc_id long, row_key long, fp long")


def _row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).isNull(), F.col(id_col).cast("long"), F.col(text_col).cast("string"))


@lru_cache(maxsize=256)
def _flips(low: int, high: int, most: int) -> np.ndarray:
    """All masks of at most ``most`` bits among bits ``low`` to ``high - 1``."""
    return np.array([sum(1 << j for j in some) for k in range(most + 1) for some in combinations(range(low, high), k)], dtype=np.uint64)


def _reach(fps: np.ndarray, spent: np.ndarray, top: int, bits: int, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The prefixes that variants of each fingerprint have in the ``bits`` bits below bit ``top``: (row, prefix bits, flips spent)."""
    rows, prefixes, costs = [], [], []
    window = np.uint64(((1 << bits) - 1) << (top - bits))
    for used in range(radius + 1):
        at = np.flatnonzero(spent == used)
        masks = _flips(top - bits, top, radius - used)
        rows.append(np.repeat(at, len(masks)))
        prefixes.append(((fps[at] & window)[:, None] ^ masks[None, :]).ravel())
        costs.append((used + np.tile(np.bitwise_count(masks), len(at))).astype(np.int8))
    return np.concatenate(rows), np.concatenate(prefixes), np.concatenate(costs)


def _deal(rows: DataFrame, top: int, bits: int, radius: int) -> DataFrame:
    """(prefix, spent, fp) rows with the next ``bits`` bits below ``top`` added to the prefix, one row per prefix reached."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k in range(0, len(b), 50_000):
                part = b.iloc[k:k + 50_000]
                fps, prefix = part["fp"].to_numpy(np.int64).view(np.uint64), part["prefix"].to_numpy(np.int64).view(np.uint64)
                at, more, cost = _reach(fps, part["spent"].to_numpy(), top, bits, radius)
                yield pd.DataFrame({"prefix": (prefix[at] | more).view(np.int64), "spent": cost.astype(np.int32), "fp": fps[at].view(np.int64)})

    return rows.mapInPandas(run, "prefix long, spent int, fp long")


def _merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least-index labels after joining the classes of each pair (a, b)."""
    while True:
        la, lb = label[a], label[b]
        if (open_ := la != lb).sum() == 0:
            return label
        a, b, low, high = a[open_], b[open_], np.minimum(la, lb)[open_], np.maximum(la, lb)[open_]
        np.minimum.at(label, high, low)
        while not np.array_equal(label, again := label[label]):
            label = again


def meet(fps: np.ndarray, spent: np.ndarray, top: int, radius: int, max_bits: int, most: int = 500_000) -> tuple[np.ndarray, np.ndarray]:
    """Links among fingerprints of one prefix (bits ``top`` and above): (root, member) of each class that meets here.

    Fingerprints that emit the same variant are within ``2 * radius`` bits of
    each other; chains along each variant, verified by bit distance, keep the
    classes without writing all pairs. Variants are written out for a slice of
    prefixes at a time, about ``most`` at once.
    """
    label = np.arange(len(fps))
    per = max(1, len(_flips(0, top, radius)))
    bits = min(top, max(0, int(np.ceil(np.log2(max(1, len(fps) * per / most))))))
    at, sub, cost = _reach(fps, spent, top, bits, radius)
    order = np.argsort(sub, kind="stable")
    at, sub, cost = at[order], sub[order], cost[order]
    cuts = [0, *(np.flatnonzero(np.diff(sub)) + 1).tolist(), len(sub)]
    taken, first = 0, 0
    for k in range(1, len(cuts)):
        taken += cuts[k] - cuts[k - 1]
        if k < len(cuts) - 1 and taken * per < most:
            continue
        part = slice(cuts[first], cuts[k])
        first, taken = k, 0
        values, owners = [], []
        low = np.uint64((1 << (top - bits)) - 1)
        for used in range(radius + 1):
            some = np.flatnonzero(cost[part] == used) + part.start
            masks = _flips(0, top - bits, radius - used)
            base = sub[some] | (fps[at[some]] & low)
            values.append((base[:, None] ^ masks[None, :]).ravel())
            owners.append(np.repeat(at[some], len(masks)))
        value, owner = np.concatenate(values), np.concatenate(owners)
        order = np.argsort(value)
        value, owner = value[order], owner[order]
        same = np.flatnonzero(value[1:] == value[:-1])
        pair = np.unique((np.minimum(owner[same], owner[same + 1]) << 32) | np.maximum(owner[same], owner[same + 1]))
        a, b = pair >> 32, pair & 0xFFFFFFFF
        near = np.bitwise_count(fps[a] ^ fps[b]) <= max_bits
        if near.all():
            label = _merged(label, a, b)
        else:  # an odd limit: a chain may hold pairs one bit too far apart, so all members of its variants are compared in turn
            label = _merged(label, *_close_pairs(fps, value, owner, max_bits))
    member = np.flatnonzero(label != np.arange(len(label)))
    return fps[label[member]], fps[member]


def _close_pairs(fps: np.ndarray, value: np.ndarray, owner: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within ``max_bits`` among the owners of equal values, by comparing at growing offsets along each run."""
    lefts, rights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    step = 1
    while len(same := np.flatnonzero(value[step:] == value[:-step])):
        a, b = owner[same], owner[same + step]
        near = np.bitwise_count(fps[a] ^ fps[b]) <= max_bits
        lefts.append(a[near])
        rights.append(b[near])
        step += 1
    return np.concatenate(lefts), np.concatenate(rights)


def links(fps: DataFrame, max_bits: int = 4, prefix_bits: int = 8, most_rows: int = 200_000, step_bits: int = 4) -> DataFrame:
    """(a, b): links that keep the classes of distinct fingerprints at most ``max_bits`` apart, from a column ``fp``.

    ``prefix_bits`` and ``most_rows`` only lay out the work: prefixes with more
    than ``most_rows`` fingerprints are split by ``step_bits`` further bits until
    none is left. The links do not depend on them.
    """
    radius = -(-max_bits // 2)
    todo = _deal(fps.select(F.lit(0).cast("long").alias("prefix"), F.lit(0).alias("spent"), "fp"), 64, prefix_bits, radius)
    top, found = 64 - prefix_bits, []

    def at(rows: DataFrame, top: int) -> DataFrame:
        def run(key, group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("fp")
            a, b = meet(group["fp"].to_numpy(np.int64).view(np.uint64), group["spent"].to_numpy(), top, radius, max_bits)
            return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})
        return rows.groupBy("prefix").applyInPandas(run, "a long, b long")

    while True:
        todo = written(todo, "dealt")
        size = written(todo.groupBy("prefix").agg(F.count("*").alias("n")), "sizes")
        crowded = size.filter((F.col("n") > most_rows) & F.lit(top > step_bits)).select("prefix")
        if crowded.isEmpty():
            found.append(at(todo, top))
            break
        found.append(at(todo.join(crowded, "prefix", "left_anti"), top))
        todo = _deal(todo.join(crowded, "prefix", "left_semi").select("prefix", "spent", "fp"), top, step_bits, radius)
        top -= step_bits
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """(doc_id, row_key, fp, root, component_id) per row of ``docs``; ``root`` is the class's least fingerprint, never null."""
    prints = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(distinct.select("fp"), max_bits), "a", "b").select(F.col("node").alias("fp"), "root")
    rooted = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(rooted.select("fp", "root").join(named, "root"), "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per row of ``docs``.

    ``component_id`` is the least doc_id that can be reached over fingerprints
    at most ``max_bits`` bits apart. Null and empty texts have fingerprint zero
    and link like any other; null doc_ids take part but are never the least
    (a class of null ids only has a null component_id); repeated rows all come
    back; other columns of ``docs`` play no part; no rows give no rows.
    """
    found = classes(docs, id_col, text_col, shingle, max_bits)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one document of each near-duplicate class: that of the least doc_id (nulls last, then by hash of the text).

    Rows that repeat both doc_id and text are one document. All columns stay as they are.
    """
    first = classes(docs, shingle=shingle, max_bits=max_bits).groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("first"))
    key = "_kept_row_key"
    rows = docs.withColumn(key, _row_key("doc_id", "text")).join(first.select(F.col("first.row_key").alias(key)), key, "left_semi")
    return rows.dropDuplicates([key]).drop(key)
