"""Benchmark decontamination by template canonicalisation.

Words of documents and benchmark items become templates: numbers, units after
numbers and names are replaced with typed placeholders, everything else is
lower-cased with outer punctuation removed. Windows of ``WINDOW`` template
words (the whole item, if it is shorter) are hash-joined, and the slots behind
the placeholders must be consistent in each window that a document shares with
an item: one document value for each item value. That finds literal leaks (each
value its own image) and re-parameterised questions (new values, same pattern;
two item values may get one new value), and rejects texts that merely have the
same shape. Windows are judged by themselves, so a value changed in one place
leaves the literal windows beside it; runs are the longest stretches of adjacent
windows that are consistent together.

Names are told by capitals inside a sentence, so a text in lower case or one
that begins elsewhere has other placeholders; a second template that leaves
names as words catches those. A third takes capitalised first words of sentences
for names as well. Windows with too few literal words have no template; they are
joined on their words as they are, values included.

A bit table of fixed size says which window hashes the benchmark has. Tasks
drop other windows before the shuffle; the join itself is exact and is Spark's
to lay out, so it holds for a benchmark of any size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import WordCoder, map_batches, pieces, written

WINDOW, LITERALS, FILTER_BITS = 13, 0.5, 24
#: Items of fewer words match only texts that hold no other word: "the" is in every text and tells nothing.
LEAST_INSIDE = 3

#: Words that are units when a number precedes them.
UNITS = frozenset("""mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t lb lbs oz ounce ounces pound pounds gram grams kilogram
kilograms ton tons ml l cl liter liters litre litres gallon gallons ms s sec second seconds min minute minutes h hr hour hours day days week weeks month
months year years meter meters metre metres kilometer kilometers kilometre kilometres degree degrees percent dollar dollars cent cents euro euros w kw mw
hz khz mhz ghz b kb mb gb tb bit bits byte bytes joule joules watt watts volt volts kph mph""".split())

LITERAL, NUMBER, UNIT, NAME = range(4)
_PART = re.compile(r"(\d+(?:[.,:/]\d+)*)|([^\W\d_]+(?:['’-][^\W\d_]+)*)|([%$€£°])")
_SPECIAL = re.compile(r"[\d%$€£°]")
_WRAP = re.compile(r"^[\W_]+|[\W_]+$")
_ENDS = (".", "!", "?", ":", '."', '!"', '?"', ".)", ".'", ".”")


def _hash(word: str, kind: int = LITERAL) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "ignore"), kind)


def _parts(word: str) -> tuple[list[int], list[int], list[bool]]:
    """(literal hashes, kinds, name-likes) of the parts of a word between white space; no part for bare punctuation."""
    if not _SPECIAL.search(word):
        core = word if word.isalpha() else _WRAP.sub("", word)
        if not core:
            return [], [], []
        low = core.lower()
        return [_hash(low)], [UNIT if low in UNITS else LITERAL], [core[0] != low[0] and core[1:] == low[1:] and core.isalpha()]
    hashes, kinds, cased = [], [], []
    for number, text, sign in _PART.findall(word):
        low = (number or text or sign).lower()
        hashes.append(_hash(low))
        kinds.append(NUMBER if number else UNIT if sign or low in UNITS else LITERAL)
        cased.append(bool(text) and text[0].isupper() and text[1:].islower())
    return hashes, kinds, cased


class Templates:
    """Template words of texts, with numbers for distinct words so that each is analysed once."""

    def __init__(self):
        self.coder = WordCoder(self._add, 300_000)
        self._reset()

    def _reset(self):
        self.words, self.kind, self.cased, self.ends = (np.zeros(0, dtype=t) for t in (np.uint64, np.int8, bool, bool))
        self.start, self.count = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self._new()

    def _new(self):
        self.to_add: tuple[list, list, list, list, list] = ([], [], [], [], [])  # hashes, kinds, cased; parts and full stop of each word

    def _add(self, word: str) -> None:
        hashes, kinds, cased, parts, ends = self.to_add
        if word.isalpha():
            low = word.lower()
            hashes.append(xxhash.xxh64_intdigest(low.encode("utf-8", "ignore"), LITERAL))
            kinds.append(UNIT if low in UNITS else LITERAL)
            cased.append(word[0] != low[0] and word[1:] == low[1:])
            parts.append(1)
            ends.append(False)
            return
        h, k, c = _parts(word)
        hashes += h
        kinds += k
        cased += c
        parts.append(len(h))
        ends.append(word.endswith(_ENDS))

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of all texts one after another: (hash of each word as it is, kind with names, kind with names that begin sentences too, kind without names); and the words of each text."""
        if self.coder.shed():
            self._reset()
        split = [(t or "").split() for t in texts]
        code = self.coder.code([w for ws in split for w in ws])
        hashes, kinds, cased, count, ends = self.to_add
        if count:
            count = np.array(count)
            self.start = np.concatenate([self.start, len(self.words) + np.cumsum(count) - count])
            self.count = np.concatenate([self.count, count])
            self.words = np.concatenate([self.words, np.array(hashes, dtype=np.uint64)])
            self.kind = np.concatenate([self.kind, np.array(kinds, dtype=np.int8)])
            self.cased = np.concatenate([self.cased, np.array(cased, dtype=bool)])
            self.ends = np.concatenate([self.ends, np.array(ends, dtype=bool)])
            self._new()
        sizes = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        n = self.count[code]
        ahead = np.concatenate([[0], np.cumsum(n)])
        first = ahead[:-1]
        at = np.repeat(self.start[code] - first, n) + np.arange(int(n.sum()))
        opens = np.ones(len(code), dtype=bool)  # the first part of a word after a full stop begins a sentence
        opens[1:] = self.ends[code[:-1]]
        opens[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
        begins = np.zeros(len(at), dtype=bool)
        begins[first[n > 0]] = opens[n > 0]
        edge = np.concatenate([[0], np.cumsum(sizes)])
        parts = np.diff(ahead[edge])
        kind = self.kind[at]
        if len(kind):
            loose = kind == UNIT
            after = np.zeros(len(kind), dtype=bool)
            after[1:] = kind[:-1] == NUMBER
            after[ahead[edge[:-1]][parts > 0]] = False
            kind[loose & ~after] = LITERAL
        cased = (kind == LITERAL) & self.cased[at]
        return self.words[at], np.where(cased & ~begins, np.int8(NAME), kind), np.where(cased, np.int8(NAME), kind), kind, parts


def windows(words: np.ndarray, kind: np.ndarray, starts: np.ndarray, size: int, exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the window of ``size`` template words at each start, whether enough of it is literal).

    ``exact``: the words themselves are hashed, and wanted where too few are
    literal, or would be if the first (a unit only after a number) were not.
    """
    place = np.array([0, *(_hash("<slot>", k) for k in (NUMBER, UNIT, NAME))], dtype=np.uint64)
    slots = kind != LITERAL
    template = words.copy()
    if not exact:
        template[slots] = place[kind[slots]]
    odd, out = np.uint64(0x9E3779B97F4A7C15), np.full(len(starts), size + (exact << 32), dtype=np.uint64)
    row = len(starts) and (starts[-1] - starts[0] + 1 == len(starts))  # starts without gaps are read as slices
    for k in range(size):
        out ^= template[starts[0] + k:starts[0] + k + len(starts)] if row else template[starts + k]
        out *= odd
        out ^= out >> np.uint64(29)
    literal = np.concatenate([[0], np.cumsum(~slots)])
    found = literal[starts + size] - literal[starts]
    return out.view(np.int64), found < np.ceil(size * LITERALS) + 1 if exact else found >= np.ceil(size * LITERALS)


def _window_rows(texts: pa.Array, ids: pa.Array, sizes: list[int] | None, window: int, wanted: np.ndarray | None, template: Templates) -> pa.RecordBatch:
    """(id, start, size, hash, slots): windows of the given ``sizes`` whose hash may be ``wanted``; without sizes, each text's own, ``window`` words at most.

    A window is hashed without names as placeholders, again with them if it has any, and with those that begin
    sentences if it has any; without placeholders (and slots) if too little of it is literal.
    """
    words, named, opened, plain, parts = template.of(texts.to_pylist())
    begin = np.cumsum(parts) - parts
    owner = np.repeat(np.arange(len(parts)), parts)
    left = np.repeat(begin + parts, parts) - np.arange(len(words))  # words from here to the end of the text
    own = np.minimum(parts, window)[owner] if len(words) else left
    has_name = np.concatenate([[0], np.cumsum(named == NAME)])
    has_opening = np.concatenate([[0], np.cumsum(opened != named)])
    literal = np.concatenate([[0], np.cumsum(plain == LITERAL)])
    got: list[tuple] = []
    for size in sizes if sizes is not None else sorted(set(np.minimum(parts, window).tolist()) - {0}):
        fits = np.flatnonzero((left >= size) & (own == size)) if sizes is None else np.flatnonzero(left >= size)
        if sizes is not None and size < LEAST_INSIDE:
            fits = fits[parts[owner[fits]] == size]
        poor = fits[literal[fits + size] - literal[fits] < np.ceil(size * LITERALS) + 1]
        for kind, starts, exact in ((plain, fits, False), (named, fits[has_name[fits + size] > has_name[fits]], False),
                                    (opened, fits[has_opening[fits + size] > has_opening[fits]], False), (plain, poor, True)):
            if not len(starts):
                continue
            hashes, rich = windows(words, kind, starts, size, exact)
            if wanted is not None:
                bit = hashes.view(np.uint64) >> np.uint64(64 - FILTER_BITS)
                rich &= ((wanted[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
            for k in np.flatnonzero(rich).tolist():
                at = int(starts[k])
                slots = [] if exact else words[at:at + size][kind[at:at + size] != LITERAL].view(np.int64).tolist()
                got.append((int(owner[at]), at - int(begin[owner[at]]), size, int(hashes[k]), slots))
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([ids.take(pa.array([g[0] for g in got], pa.int64())), *(pa.array([g[k + 1] for g in got], kinds[k]) for k in range(4))], ["id", "start", "size", "hash", "slots"])


_SCHEMA = "id long, start long, size int, hash long, slots array<long>"
_RUNS = "doc_id long, item_id long, first_word long, last_word long, windows long, slots int, reparameterised boolean"


def runs(windows: list[dict]) -> Iterator[tuple[int, int, int, int, bool]]:
    """(first word, last word, windows, slots, reparameterised) of the maximal runs among the windows of a diagonal, sorted by start.

    Windows of a run overlap or touch, and each item value has one document
    value over all of them. Every window must be consistent by itself.
    """
    images: dict[int, dict[int, int]] = {}  # item value: document values with their number of places
    left = reach = 0

    def run(upto: int) -> tuple[int, int, int, int, bool]:
        part = windows[left:upto]
        return (part[0]["start"], max(w["start"] + w["size"] for w in part) - 1, len({w["start"] for w in part}),
                sum(map(len, images.values())), any(a != b for b, values in images.items() for a in values))

    for right, w in enumerate(windows):
        fits = lambda: w["start"] <= reach and all(images.get(b, {a: 1}).keys() == {a} for a, b in zip(w["ours"], w["theirs"]))  # noqa: E731, B023
        if right and not fits():
            yield run(right)
            while left < right and not fits():
                for a, b in zip(windows[left]["ours"], windows[left]["theirs"]):
                    images[b][a] -= 1
                    if not images[b][a]:
                        del images[b][a]
                    if not images[b]:
                        del images[b]
                left += 1
        for a, b in zip(w["ours"], w["theirs"]):
            images.setdefault(b, {}).setdefault(a, 0)
            images[b][a] += 1
        reach = max(reach, w["start"] + w["size"])
    if windows:
        yield run(len(windows))


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, item_id, first_word, last_word, windows, slots, reparameterised): runs that documents share with benchmark items.

    A run lies on one diagonal (document position minus item position) and has
    consistent slots. Items shorter than ``window`` words match as a whole, those
    of fewer than ``LEAST_INSIDE`` words only a text that is no longer than they
    are; items without a word match nothing. Null ids and texts match nothing;
    repeated rows fall into the same runs; other columns play no part.
    """
    spark = docs.sparkSession
    texts = lambda d, i: d.select(F.col(i).cast("long").alias("id"), F.col("text").cast("string").alias("text")).filter("id is not null and text is not null")

    def items():
        template = Templates()

        def batch(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in pieces(rows):
                yield _window_rows(part.column(1), part.column(0), None, window, None, template)
        return batch

    wanted = written(map_batches(texts(benchmark, "item_id"), items, _SCHEMA).distinct(), "item-windows")
    sizes = sorted(r[0] for r in wanted.select("size").distinct().collect())  # at most `window` of them
    bits = wanted.select(F.shiftrightunsigned("hash", 64 - FILTER_BITS).alias("bit")).distinct().toArrow().column("bit").to_numpy()  # at most 2**FILTER_BITS
    table = np.zeros(1 << (FILTER_BITS - 3), dtype=np.uint8)
    np.bitwise_or.at(table, bits >> 3, (1 << (bits & 7)).astype(np.uint8))
    shared = spark.sparkContext.broadcast(table)

    def documents():
        template = Templates()

        def batch(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in pieces(rows):
                yield _window_rows(part.column(1), part.column(0), sizes, window, shared.value, template)
        return batch

    found = written(map_batches(texts(docs, "doc_id"), documents, _SCHEMA), "document-windows")
    met = found.select(F.col("id").alias("doc_id"), "start", "size", "hash", F.col("slots").alias("ours")).join(
        wanted.select(F.col("id").alias("item_id"), F.col("start").alias("at"), F.col("size").alias("item_size"), "hash", F.col("slots").alias("theirs")), "hash")
    met = met.filter("size = item_size and size(ours) = size(theirs)").distinct()
    one_image = F.expr("size(array_distinct(zip_with(ours, theirs, (a, b) -> struct(a, b)))) = size(array_distinct(theirs))")
    diagonals = met.filter(one_image).groupBy("doc_id", "item_id", (F.col("start") - F.col("at")).alias("diagonal")).agg(
        F.sort_array(F.collect_set(F.struct("start", "size", "ours", "theirs"))).alias("met"))

    def diagonal():
        def batch(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            got = [(doc.as_py(), item.as_py(), *run) for doc, item, windows_ in zip(*rows.columns) for run in runs(windows_.as_py())]
            kinds = [pa.int64()] * 5 + [pa.int32(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array([g[k] for g in got], t) for k, t in enumerate(kinds)], [c.split()[0] for c in _RUNS.split(", ")])
        return batch

    return map_batches(diagonals.select("doc_id", "item_id", "met"), diagonal, _RUNS)


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, item_id, first_word, last_word, windows, reparameterised): one row per document and item, spanning its consistent runs."""
    runs = matches(docs, benchmark, window)
    return runs.groupBy("doc_id", "item_id").agg(
        F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word"), F.max("windows").alias("windows"),
        F.min("reparameterised").alias("reparameterised"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that share a consistent run with a benchmark item; all others, with all columns, stay."""
    marked = "_contaminated"
    return docs.join(leaks(docs, benchmark, window).select(F.col("doc_id").alias(marked)).distinct(), F.col("doc_id") == F.col(marked), "left_anti")
