"""Importance resampling towards a target distribution: array-scored weights, ranks by regular sampling.

Features are runs of 1 to 3 words, hashed into a fixed number of buckets. The
counts of all rows on both sides give one gain a bucket, an array of fixed size
that every task holds; a document's weight is the sum of its features' gains,
and Gumbel noise from a hash of its id turns the highest scores into a draw
without replacement.

The ranks come from parallel sorting by regular sampling. Runs of rows are
sorted where they lie; regular positions of each run give the splitters; the
counts of every segment between two splitters, added up in order, give the rank
at which each segment begins. So only segments that begin within the draw are
exchanged at all, and each is merged by itself. A row's place in its run ends
its key, so no key repeats and equal rows, however many, are split as well.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import pieces, written

BUCKETS, WORDS, SEED = 10_000, 3, 42
#: Rows a run is meant to hold, bounds of the number of runs, and how many regular positions of a run are looked at.
RUN_ROWS, LEAST_RUNS, MOST_RUNS, POSITIONS = 1 << 16, 8, 1024, 256

#: Each byte as it counts in a word: A-Z lower-cased, ASCII letters, digits and all bytes of other characters; 0 separates.
_WORD_BYTES = np.array([b | 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], dtype=np.uint8)


class Crc:
    """crc32 of many words at a time, and of words joined by spaces: crc32 is linear, so a shift by n bytes is one table of 4 x 256 values."""

    #: Words of fewer bytes are taken byte by byte, all at once; longer ones one by one.
    SHORT = 64

    def __init__(self):
        byte = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(0xEDB88320), byte >> 1).astype(np.uint32)
        value = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
        self.byte, self.powers = byte, [(value >> 8) ^ byte[value & 255]]
        self.tables = np.stack([value, *[self.table(n) for n in range(1, self.SHORT)]]).reshape(-1)

    def table(self, length: int) -> np.ndarray:
        """The effect of ``length`` more bytes, from those of powers of two."""
        out, bit = None, 0
        while length >> bit:
            if bit == len(self.powers):
                self.powers.append(self.apply(self.powers[-1], self.powers[-1]))
            if length >> bit & 1:
                out = self.powers[bit] if out is None else self.apply(self.powers[bit], out)
            bit += 1
        return out

    @staticmethod
    def apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        return table[0][crc & 255] ^ table[1][crc >> 8 & 255] ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24]

    def of(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """crc32 of each run ``data[start:start + length]``."""
        short = np.minimum(length, self.SHORT)
        order = np.argsort(-short.astype(np.int8), kind="stable")
        begin, sizes = start[order], length[order]
        crc = np.full(len(start), 0xFFFFFFFF, dtype=np.uint32)
        more = np.searchsorted(-short[order], -np.arange(min(int(short.max(initial=0)), self.SHORT - 1)), "left")
        for j, n in enumerate(more):  # the first n are longer than j
            some = crc[:n]
            crc[:n] = self.byte[(some ^ data[begin[:n] + j]) & 255] ^ (some >> 8)
        crc = ~crc
        for k in range(int((sizes >= self.SHORT).sum())):
            crc[k] = zlib.crc32(data[begin[k]:begin[k] + sizes[k]].tobytes())
        out = np.empty_like(crc)
        out[order] = crc
        return out

    def joined(self, crc: np.ndarray, next_crc: np.ndarray, next_length: np.ndarray) -> np.ndarray:
        """crc32 of ``first + b" " + second`` from the crc32 of each and the second's length."""
        spaced = ~(self.byte[(~crc ^ np.uint32(32)) & 255] ^ (~crc >> 8))
        base = np.minimum(next_length, self.SHORT - 1) << 10
        at = self.tables
        moved = at[base + (spaced & 255)] ^ at[base + 256 + (spaced >> 8 & 255)] ^ at[base + 512 + (spaced >> 16 & 255)] ^ at[base + 768 + (spaced >> 24)]
        for k in np.flatnonzero(next_length >= self.SHORT):
            moved[k] = self.apply(self.table(int(next_length[k])), spaced[k:k + 1])[0]
        return moved ^ next_crc


class Hasher:
    """Buckets of all features of whole texts, in numpy."""

    def __init__(self, buckets: int = BUCKETS, most_words: int = WORDS):
        self.buckets, self.most_words, self.crc = buckets, most_words, Crc()

    def of(self, texts: pa.Array) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Number of words of each text, and for each run length the (positions of first words, buckets) of its features."""
        raw = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
        data = _WORD_BYTES[np.frombuffer(b" ".join([*raw, b""]) or b" ", dtype=np.uint8)]
        edge = np.flatnonzero(np.diff(data != 0, prepend=False))
        start, length = edge[::2], edge[1::2] - edge[::2]
        ends = np.cumsum([len(t) + 1 for t in raw])
        count = np.diff(np.searchsorted(start, ends), prepend=0)
        word = self.crc.of(data, start, length)
        owner = np.repeat(np.arange(len(raw), dtype=np.int32), count)
        at, crc, found = np.arange(len(word)), word, []
        for k in range(self.most_words):
            if k:
                at = at[:np.searchsorted(at, len(word) - k)]
                same = owner[at] == owner[at + k]
                crc, at = crc[:len(at)][same], at[same]
                crc = self.crc.joined(crc, word[at + k], length[at + k])
            found.append((at, (crc % np.uint32(self.buckets)).astype(np.int64)))
        return count, found


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, most_words: int = WORDS) -> np.ndarray:
    """How many features of all rows fall into each bucket; ``buckets`` numbers come to the driver, whatever the input."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = Hasher(buckets, most_words), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for part in pieces(batch):
                for _, bucket in hasher.of(part.column(0))[1]:
                    total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    found = texts.select(F.col(text_col).cast("string").alias("text")).filter("text is not null").mapInArrow(run, "bucket int, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of target to source frequency of each bucket, one count added everywhere, rounded down."""
    s_all, t_all = float(source.sum() + len(source)), float(target.sum() + len(target))
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(source.tolist(), target.tolist())], dtype=np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """1000 times Gumbel noise of a document, rounded down; a null id hashes like an empty one."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", most_words: int = WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score), all long, of every row; a null text is an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        hasher = Hasher(len(gain), most_words)
        for batch in batches:
            for part in pieces(batch):
                count, found = hasher.of(part.column(1))
                total, features = np.zeros(int(count.sum()), dtype=np.int64), np.zeros(int(count.sum()), dtype=np.int64)
                for at, bucket in found:
                    total[at] += gain[bucket]
                    features[at] += 1
                edge = np.concatenate([[0], np.cumsum(count)])
                of_doc = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[edge])
                weight = of_doc(total)
                score = weight + np.array([noise(d, seed) for d in part.column(0).to_pylist()], dtype=np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(x.astype(np.int64)) for x in (count, of_doc(features), weight, score)]],
                                                 ["doc_id", "n_words", "n_features", "weight", "score"])

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


_RUN_BITS = 33  # monotonically_increasing_id = partition << 33 | position


def _splitters(runs: DataFrame, keys: list[str], segments: int) -> list[tuple]:
    """At most ``segments`` - 1 ascending keys that cut all rows into about equal segments, from regular positions of every run."""
    run, position = F.shiftright("place", _RUN_BITS), F.col("place").bitwiseAND((1 << _RUN_BITS) - 1)
    sizes = runs.groupBy(run.alias("run")).agg(F.count("*").alias("size"))  # a row per run: at most MOST_RUNS
    step = F.greatest(F.lit(1), F.expr(f"size div {POSITIONS}"))
    taken = runs.withColumn("run", run).join(F.broadcast(sizes), "run").filter(position % step == step - 1).select(*keys, step.alias("stands_for"))
    rows = sorted(tuple(r) for r in taken.collect())  # MOST_RUNS * 2 * POSITIONS at most
    reached = np.cumsum([r[-1] for r in rows]) if rows else np.zeros(0)
    cuts = []
    for s in range(1, segments):
        at = int(np.searchsorted(reached, reached[-1] * s / segments)) if rows else 0
        if rows and (not cuts or rows[at][:-1] > cuts[-1]):
            cuts.append(rows[at][:-1])
    return cuts


def _segmented(runs: DataFrame, keys: list[str], cuts: list[tuple]) -> DataFrame:
    """``runs`` with ``segment``: the number of splitters that come before the row (a splitter ends its own segment)."""
    columns = runs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = np.array([c[0] for c in cuts], dtype=np.int64)
        for batch in batches:
            key = [batch.column(columns.index(k)) for k in keys]
            first = key[0].to_numpy()
            segment, upper = np.searchsorted(lead, first, "left"), np.searchsorted(lead, first, "right")
            for r in np.flatnonzero(segment != upper):  # the first key column ties with a splitter's
                segment[r] = bisect_left(cuts, tuple(k[r].as_py() for k in key))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segment.astype(np.int32))], [*columns, "segment"])

    return runs.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in runs.dtypes) + ", segment int")


def first_ranks(rows: DataFrame, keys: Sequence[str], most: int, n_rows: int) -> DataFrame:
    """``rows`` with ``rank`` (long): 1, 2, 3 ... for the ``most`` first of ``n_rows`` rows in ascending order of ``keys``, else null.

    ``keys`` are long columns without nulls; rows that agree in all of them rank
    in an arbitrary but fixed order.
    """
    count = min(MOST_RUNS, max(LEAST_RUNS, -(-n_rows // RUN_ROWS)))
    keys = [*keys, "place"]
    runs = written(rows.coalesce(count).sortWithinPartitions(*keys[:-1]).withColumn("place", F.monotonically_increasing_id()), "sorted-runs")
    cuts = _splitters(runs, keys, count)
    dealt = _segmented(runs, keys, cuts)
    begins, reached = {}, 0
    for r in sorted(dealt.groupBy("segment").agg(F.count("*").alias("n")).collect()):  # a row per segment: at most MOST_RUNS
        begins[r["segment"]], reached = reached, reached + r["n"]
    wanted = [s for s, at in begins.items() if at < most]
    columns = rows.columns
    if not wanted:
        return runs.select(*columns, F.lit(None).cast("long").alias("rank"))
    last = max(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, 0
        for batch in batches:
            segment = batch.column(len(columns)).to_numpy()
            rank = np.zeros(len(segment), dtype=np.int64)
            for start in np.flatnonzero(np.diff(segment, prepend=-1)):
                if segment[start] != now:
                    now, done = segment[start], begins[int(segment[start])]
                end = start + int(np.searchsorted(segment[start:], now, "right"))
                rank[start:end] = done + 1 + np.arange(end - start)
                done += end - start
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(columns)], pa.array(rank, mask=rank > most)], [*columns, "rank"])

    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", rank long"
    exchanged = dealt.filter(F.col("segment") <= last).repartitionById(last + 1, F.col("segment")).sortWithinPartitions("segment", *keys)
    drawn = exchanged.select(*columns, "segment").mapInArrow(run, schema)
    return drawn.unionByName(dealt.filter(F.col("segment") > last).select(*columns, F.lit(None).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", buckets: int = BUCKETS, most_words: int = WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of ``docs``, all long.

    ``rank`` orders the draw: floor(percent * N / 100) of the N rows with at
    least ``least_words`` words, highest score first, ties to the lesser id
    (null last), then to the lesser weight and n_features; null for all others.
    Null texts are empty ones: no feature, weight 0. Repeated rows take part one
    by one; further columns are ignored; an empty table gives an empty result,
    an empty target a weight for every feature from the source counts alone.
    """
    gain = gains(bucket_counts(docs, text_col, buckets, most_words), bucket_counts(target, target_text_col, buckets, most_words))
    rows = written(scored(docs, gain, id_col, text_col, most_words, seed), "scores")
    able = F.col("n_words") >= least_words
    n = rows.filter(able).count()
    last = F.col("doc_id").isNull()
    keyed = rows.filter(able).select("*", (-F.col("score")).alias("down"), last.cast("long").alias("no_id"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"))
    ranked = first_ranks(keyed, ["down", "no_id", "id", "weight", "n_features"], percent * n // 100, n)
    return ranked.select(*rows.columns, "rank").unionByName(rows.filter(~able).withColumn("rank", F.lit(None).cast("long")))
