"""Byte n-grams of whole texts as packed integers, in numpy, and exact tables of model scores by n-gram.

A text is reduced to lower-case letters and marks with single spaces, in UTF-8. The
n-gram at a byte is that byte and its n - 1 predecessors (zeros before the
text), packed with the byte itself lowest: ``gram >> 8`` is its history and
``gram & (256**k - 1)`` its suffix of k bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from .common import let_go

_GAP, _LETTER = regex.compile(r"[^\p{L}\p{M}]+"), regex.compile(r"\p{L}")
_ODD = -7046029254386353131  # 2**64 / golden ratio, odd: spreads packed grams over buckets, one to one


def letters(text: str | None) -> bytes:
    """`` word word ... `` in UTF-8, marks (vowel signs, accents) with their letters; empty if the text has no letter."""
    words = _GAP.sub(" ", (text or "").lower()).strip()
    return f" {words} ".encode("utf-8", "ignore") if _LETTER.search(words) else b""


def suffix(gram: str, size: int) -> Column:
    return F.col(gram).bitwiseAND(F.lit((1 << 8 * size) - 1))


def history(gram: str) -> Column:
    return F.shiftright(F.col(gram), 8)


def mixed(keys: np.ndarray) -> np.ndarray:
    return (keys * np.int64(_ODD)).view(np.uint64)


@dataclass
class GramTable:
    """Values of each n-gram under its whole key; buckets grow with the number of n-grams (1 to 2 for each)."""

    bits: int
    first: np.ndarray  # where the keys of a bucket begin
    keys: np.ndarray  # mixed, in order, and the greatest possible one as a stop
    values: np.ndarray  # [keys, values], NaN at the stop

    @classmethod
    def of(cls, grams: np.ndarray, values: np.ndarray) -> GramTable:
        keys, bits = mixed(grams), max(len(grams).bit_length(), 1)
        order = np.argsort(keys)
        keys = np.append(keys[order], np.uint64(2**64 - 1))
        first = np.searchsorted(keys[:-1], np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
        return cls(bits, first.astype(np.int32 if len(keys) < 2**31 else np.int64), keys, np.concatenate([values[order], np.full((1, values.shape[1]), np.nan, dtype=values.dtype)]))

    def find(self, grams: np.ndarray) -> np.ndarray:
        """[grams, values]; NaN for an n-gram that is not in the table."""
        wanted = mixed(grams)
        at = self.first[(wanted >> np.uint64(64 - self.bits)).astype(np.int64)].astype(np.int64)
        todo = np.flatnonzero(self.keys[at] < wanted)
        while len(todo):
            at[todo] += 1
            todo = todo[self.keys[at[todo]] < wanted[todo]]
        at[self.keys[at] != wanted] = len(self.keys) - 1
        return self.values[at]


def chunks(texts: Iterator[bytes], order: int, by_word: bool = False, most: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(grams, document number of each, word starts) for about ``most`` bytes at a time; a longer text comes in several chunks, no byte is left out.

    ``by_word``: spaces have no gram, and a gram has zeros in place of what
    precedes its word, so that the first bytes of a word are told from the
    same bytes inside one. Word starts are positions in ``grams``.
    """
    gap, parts, owners, size = b"\0" * (order - 1), [], [], 0

    def pack():
        data = np.frombuffer(b"".join(parts), dtype=np.uint8)
        gram = data.astype(np.int64)
        wide = gram.copy()
        for k in range(1, order):
            gram[k:] |= wide[:-k] << (8 * k)
        sizes = np.array([len(p) for p in parts])
        del wide
        keep = np.ones(len(data), dtype=bool)
        starts = np.cumsum(sizes) - sizes
        for k in range(order - 1):
            keep[starts + k] = False
        first = np.zeros(0, dtype=np.int64)
        owner = np.repeat(np.array(owners), sizes)
        if by_word:
            space, at = data == 32, np.arange(len(data))
            into = at - np.maximum.accumulate(np.where(space | (data == 0), at, -1))
            gram &= np.where(into >= order, np.int64(-1), (np.int64(1) << (8 * np.minimum(into, 7))) - 1)
            keep &= ~space
            gram, owner, into = gram[keep], owner[keep], into[keep]
            first = np.flatnonzero((into == 1) | (np.diff(owner, prepend=-1) != 0))
            return gram, owner, first
        return gram[keep], owner[keep], first

    for number, text in enumerate(texts):
        padded = gap + text
        for at in range(0, len(text), most):
            piece = padded[at:at + most + order - 1]
            parts.append(piece)
            owners.append(number)
            size += len(piece)
            if size >= most:
                yield pack()
                parts, owners, size = [], [], 0
    if parts:
        yield pack()


def gram_counts(docs: DataFrame, text_col: str, class_col: str, order: int, classes: int, by_word: bool = False, hold: int = 1_000_000) -> DataFrame:
    """(gram, class, n): how often each n-gram occurs in the texts of each class (a small integer), over all rows.

    Each task adds up what it has read before anything is shuffled.
    """
    if 8 * order + classes.bit_length() > 63:
        raise ValueError("gram and class must fit 63 bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        keys, counts, held = [], [], 0

        def flush():
            key, at = np.unique(np.concatenate(keys), return_inverse=True)
            n = np.bincount(at, weights=np.concatenate(counts)).astype(np.int64)
            return key, n

        def rows(key, n):
            return pa.RecordBatch.from_arrays([pa.array(key & ((1 << 8 * order) - 1)), pa.array((key >> (8 * order)).astype(np.int32)), pa.array(n)], ["gram", "class", "n"])

        for batch in batches:
            kinds = np.array(batch.column(1).to_pylist(), dtype=np.int64)
            for grams, owner, _ in chunks((letters(x.as_py()) for x in batch.column(0)), order, by_word):
                key, n = np.unique(grams | (kinds[owner] << (8 * order)), return_counts=True)
                keys.append(key)
                counts.append(n)
                held += len(key)
                if held > hold:
                    key, n = flush()
                    keys, counts, held = ([], [], 0) if len(key) > hold // 2 else ([key], [n], len(key))
                    if not keys:
                        yield rows(key, n)
        if keys:
            yield rows(*flush())

    found = docs.select(F.col(text_col).cast("string").alias("text"), F.col(class_col).cast("int").alias("class")).filter("text is not null and class is not null")
    return found.mapInArrow(run, "gram long, class int, n long").groupBy("gram", "class").agg(F.sum("n").alias("n"))


def gram_table(rows: DataFrame, key: str, values: list[str], most: int, dtype: type = np.float32, piece_bytes: int = 64 << 20) -> GramTable:
    """Table of all ``rows``, at most ``most`` with distinct keys; they come to the driver in pieces of about ``piece_bytes``."""
    plain = rows.select(F.col(key).cast("long").alias("k"), *[F.col(v).cast("float").alias(f"v{i}") for i, v in enumerate(values)])
    count = -(-max(most, 1) * (8 + 4 * len(values)) // piece_bytes)
    keys, found = [], []
    for part in range(count):
        got = (plain.filter(F.pmod(F.xxhash64("k"), F.lit(count)) == part) if count > 1 else plain).toArrow()
        keys.append(got.column("k").to_numpy())
        found.append(np.stack([got.column(f"v{i}").to_numpy() for i in range(len(values))], axis=1).astype(dtype))
    return GramTable.of(np.concatenate(keys), np.concatenate(found))
