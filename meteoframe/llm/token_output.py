"""Token ids in packs of separately compressed documents that share one zstandard dictionary.

A document's ids (the end id last) are 16-bit little-endian numbers if the
vocabulary allows, else 32-bit. Every document is a zstandard frame of its own,
so one can be read without its neighbours; the dictionary, trained on the ids of
a bounded sample, makes up for what short documents lose by that.

The files are Parquet rows, one pack of documents each: the frames one after
another (``payload``), the offset index (``doc_ids``, ``offsets``, ``n_tokens``,
``starts``: ids of all documents before each one) and the hash of the
dictionary. ``dictionary/`` beside ``packs/`` holds the dictionary under the
same hash. Packs lie in ascending doc_id order, and Parquet's statistics of
``first_doc_id`` and ``last_doc_id`` lead to the pack of a document.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType

from .common import WordCoder, kept, map_batches, pieces, shared_dir, written

TOKENIZER, END_ID = "word_bpe_49k.json", 2
#: The dictionary's size, and the bound of the sample that it is trained on.
DICTIONARY_BYTES, SAMPLE_DOCS, SAMPLE_IDS = 64 << 10, 2_000, 4_096
PACK_BYTES, LEVEL = 1 << 20, 3


def _tokenizer(name: str):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(name if "/" in name else public_tokenizers.path(name))


_MARK = re.compile("[\u0300-\u036f]")
#: What a byte is: an ASCII letter or digit, a stop, a space or line end.
_LETTER, _STOP, _SPACE = 1, 2, 3
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123)]] = _LETTER
_KIND[list(b".,;:!?")] = _STOP
_KIND[[10, 32]] = _SPACE
#: Encoded between words that are encoded together, and looked for in the ids.
_BAR = "|"
#: Texts by which a tokenizer shows whether it cuts where :class:`Encoder` does.
_PROBES = ("The cat's mat, 12 KG; ok.\nNext: yes! no? a.b  c\n\n d .e", "é\u0301 ÀÉ. x|y | z", " lead and trail ", "don't I'll 3.14, A_B-c", "日本 語。 ok")


class Encoder:
    """Token ids of whole texts.

    A tokenizer that removes white space and never joins what stands on its two
    sides gives a text the ids of its words in turn; each distinct word is then
    encoded once. Texts are cut at spaces, line ends and before a stop after an
    ASCII letter or digit; a word may hold other white space, which is the
    tokenizer's to remove. If it lower-cases, A-Z are lowered here, except before
    combining marks, which it composes first. Whether a tokenizer is of this
    kind is found out from ``_PROBES``; others encode every text as a whole.
    """

    def __init__(self, name: str = TOKENIZER):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks run side by side already
        self.tokenizer = _tokenizer(name)
        self.lowers = self.tokenizer.normalizer is not None and self.tokenizer.normalizer.normalize_str("AZ") == "az"
        self.coder = WordCoder(lambda w: w, 600_000)
        self.flat, self.start, self.count = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        bar = self._whole(_BAR)
        self.bar = int(bar[0]) if len(bar) == 1 else None
        self.by_word = self.tokenizer.truncation is None and self.tokenizer.padding is None and all(
            np.array_equal(np.concatenate([self._whole(w.decode("utf-8", "replace")) for w in self.words(t)]), self._whole(t)) for t in _PROBES)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def words(self, text: str) -> list[bytes]:
        data = text.encode("utf-8", "surrogatepass")
        if self.lowers and not (not text.isascii() and _MARK.search(text)):
            data = data.lower()
        raw = np.frombuffer(data, dtype=np.uint8)
        kind = _KIND[raw]
        at = np.flatnonzero(kind[1:-1] == _STOP) + 1
        at = at[(kind[at - 1] == _LETTER) & (kind[at + 1] == _SPACE)]
        if len(at):
            wide = np.full(len(raw) + len(at), 32, dtype=np.uint8)
            keep = np.ones(len(wide), dtype=bool)
            keep[at + np.arange(len(at))] = False
            wide[keep] = raw
            data = wide.tobytes()
        return data.replace(b"\n", b" ").split(b" ")

    def _encoded(self, words: list[bytes]) -> tuple[list[int], list[int]]:
        """Ids of ``words`` one after another, and how many each has."""
        text = [w.decode("utf-8", "surrogatepass") for w in words]
        ids, count = [], []
        if self.bar is not None and not any(_BAR in w for w in text):
            both = np.array(self.tokenizer.encode_batch_fast([f" {_BAR} ".join([*text, ""])], add_special_tokens=False)[0].ids, dtype=np.int64)
            ends = np.flatnonzero(both == self.bar)
            if len(ends) == len(words):  # else a word gave the bar's id
                return both[both != self.bar].tolist(), (np.diff(ends, prepend=-1) - 1).tolist()
        for one in self.tokenizer.encode_batch_fast(text, add_special_tokens=False):
            some = one.ids
            ids += some
            count.append(len(some))
        return ids, count

    def of(self, texts: list[str | None]) -> list[np.ndarray]:
        if not self.by_word:
            return [np.array(x.ids, dtype=np.uint32) for x in self.tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
        if self.coder.shed():
            self.flat, self.start, self.count = self.flat[:0], self.start[:0], self.count[:0]
        codes = [self.coder.code(self.words(t)) if t else np.zeros(0, dtype=np.int64) for t in texts]
        new = self.coder.facts[len(self.count):]
        if new:
            parts, count = [], []
            for k in range(0, len(new), 512):
                ids, n = self._encoded(new[k:k + 512])
                parts += ids
                count += n
            count, flat = np.array(count, dtype=np.int64), np.array(parts, dtype=np.uint32)
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(count) - count])
            self.count = np.concatenate([self.count, count])
            self.flat = np.concatenate([self.flat, flat])
        out = []
        for code in codes:
            n = self.count[code]
            first = np.cumsum(n) - n
            out.append(self.flat[np.repeat(self.start[code] - first, n) + np.arange(int(n.sum()))])
        return out


def _encoder(name: str) -> Encoder:
    """The encoder of a worker process; its words, bounded in number, serve the next task too, until one of another stage comes."""
    return kept(_kept_name(name), lambda: Encoder(name))


def _kept_name(tokenizer: str) -> str:
    return f"encoder {tokenizer}"


def _frames(docs: DataFrame, dictionary: bytes, width: str, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, n_tokens, crc, frame) per document: its ids and the end id, compressed on their own."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionary)

    def make():
        encoder, packer = _encoder(tokenizer), _compressor(shared.value)

        def batch(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in pieces(rows):
                ids = [np.append(x, np.uint32(end_id)) for x in encoder.of(part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                    pa.array([packer.compress(x.astype(width).tobytes()) for x in ids], pa.binary())], ["doc_id", "n_tokens", "crc", "frame"])
        return batch

    return map_batches(docs, make, "doc_id long, n_tokens long, crc long, frame binary", _kept_name(tokenizer))


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def _sample(docs: DataFrame, width: str, tokenizer: str) -> list[bytes]:
    """Serialized ids of at most SAMPLE_DOCS documents, chosen by hash: of each, a run of SAMPLE_IDS ids at most."""
    def make():
        encoder = _encoder(tokenizer)

        def batch(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in pieces(rows):
                yield pa.RecordBatch.from_arrays([pa.array([x[:SAMPLE_IDS].astype(width).tobytes() for x in encoder.of(part.column(1).to_pylist())], pa.binary())], ["ids"])
        return batch

    some = docs.select(F.xxhash64("doc_id").alias("h")).orderBy("h").limit(SAMPLE_DOCS).agg(F.max("h")).first()[0]
    if some is None:
        return []
    return [r["ids"] for r in map_batches(docs.filter(F.xxhash64("doc_id") <= some), make, "ids binary", _kept_name(tokenizer)).limit(SAMPLE_DOCS).collect()]


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary of at most ``size`` bytes; empty if the samples are too few to train one."""
    if sum(map(len, samples)) < 8 * 1024 or len(samples) < 8:
        return b""
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, samples)) // 4), samples, threads=0).as_bytes()
    except zstandard.ZstdError:  # samples without anything in common
        return b""


def dictionary_hash(dictionary: bytes) -> str:
    return xxhash.xxh64_hexdigest(dictionary)


def write(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> str:
    """Write the packs and the dictionary of ``docs`` (doc_id, text) below ``path``; the hash of the dictionary.

    Null texts are empty ones; null doc_ids come first, repeated ones lie side
    by side; an empty table writes no pack.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    width = "<u2" if _tokenizer(tokenizer).get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else "<u4"
    dictionary = train_dictionary(_sample(docs, width, tokenizer))
    name = dictionary_hash(dictionary)
    spark.createDataFrame([(name, bytearray(dictionary), width)], "dictionary_hash string, dictionary binary, width string").coalesce(1).write.parquet(f"{path}/dictionary")
    frames = written(_frames(docs, dictionary, width, tokenizer, end_id), "frames")
    order = ["doc_id", "n_tokens", "crc"]
    ordered = frames.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def make():
        state = {"at": 0, "part": None, "pack": 0}

        def batch(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            ids, counts, frame = rows.column(0).to_pylist(), rows.column(1).to_pylist(), rows.column(3)
            part = rows.column(4)[0].as_py()
            if state["part"] != part:
                state.update(at=0, part=part, pack=0)
            blobs = [x.as_py() for x in frame]
            begin, size = 0, 0
            packs: list[tuple] = []
            for k, blob in enumerate(blobs):
                size += len(blob)
                if size >= PACK_BYTES or k == len(blobs) - 1:
                    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blobs[begin:k + 1]])])
                    starts = state["at"] + np.concatenate([[0], np.cumsum(counts[begin:k + 1])])
                    packs.append((part, state["pack"], ids[begin], ids[k], name, ids[begin:k + 1], offsets.tolist(), counts[begin:k + 1], starts[:-1].tolist(), b"".join(blobs[begin:k + 1])))
                    state["at"], state["pack"] = int(starts[-1]), state["pack"] + 1
                    begin, size = k + 1, 0
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in packs], kind) for i, kind in enumerate(
                [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()])], _PACK)
        return batch

    map_batches(ordered.select(*order, "frame", "part"), make, _PACK_SCHEMA).write.parquet(f"{path}/packs")
    return name


_PACK = ["part", "pack", "first_doc_id", "last_doc_id", "dictionary_hash", "doc_ids", "offsets", "n_tokens", "starts", "payload"]
_PACK_SCHEMA = ("part int, pack int, first_doc_id long, last_doc_id long, dictionary_hash string, doc_ids array<long>, offsets array<long>, "
                "n_tokens array<long>, starts array<long>, payload binary")


def _opened(spark: SparkSession, path: str, packs: DataFrame | None, columns: dict[str, tuple[str, Callable[[np.ndarray], object]]]) -> DataFrame:
    """(doc_id, start, columns...) of every document in the files at ``path``; of some ``packs`` only, if given.

    ``columns``: what tasks make of a document's ids, by name, with its type.
    ``start`` counts the ids of all documents before. A pack counts from the
    beginning of its part; the parts before it are added up from the index alone.
    """
    every = spark.read.schema(_PACK_SCHEMA).parquet(f"{path}/packs")
    parts = every.groupBy("part").agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast(LongType()), lambda a, n: a + n)).alias("n")).orderBy("part").collect()  # a row per file part
    before, total = [0] * (1 + max((r["part"] for r in parts), default=-1)), 0
    for r in parts:
        before[r["part"]], total = total, total + r["n"]
    held = {r["dictionary_hash"]: (bytes(r["dictionary"]), r["width"]) for r in spark.read.parquet(f"{path}/dictionary").collect()}  # one row
    shared = spark.sparkContext.broadcast((before, held))

    def make():
        before, held = shared.value
        openers = {name: (_decompressor(dictionary), width) for name, (dictionary, width) in held.items()}

        def batch(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for r in range(rows.num_rows):
                part, name, doc_ids, offsets, starts, payload = (rows.column(_PACK.index(c))[r].as_py() for c in ("part", "dictionary_hash", "doc_ids", "offsets", "starts", "payload"))
                opener, width = openers[name]
                for at in range(0, len(doc_ids), 500):
                    to = min(at + 500, len(doc_ids))
                    ids = [np.frombuffer(opener.decompress(payload[offsets[k]:offsets[k + 1]]), dtype=width).astype("<u4") for k in range(at, to)]
                    found = [pa.array([of(x) for x in ids], pa.binary() if kind == "binary" else pa.int64()) for kind, of in columns.values()]
                    yield pa.RecordBatch.from_arrays([pa.array(doc_ids[at:to], pa.int64()), pa.array([before[part] + s for s in starts[at:to]], pa.int64()), *found], ["doc_id", "start", *columns])
        return batch

    return map_batches(every if packs is None else packs, make, "doc_id long, start long, " + ", ".join(f"{c} {kind}" for c, (kind, _) in columns.items()))


def read(spark: SparkSession, path: str, packs: DataFrame | None = None) -> DataFrame:
    """(doc_id, start, ids) of every document in the files at ``path`` (of some ``packs``): ids as little-endian unsigned 32-bit integers."""
    return _opened(spark, path, packs, {"ids": ("binary", lambda x: x.tobytes())})


def read_document(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """(doc_id, start, ids) of one document: Parquet statistics lead to its pack, the offset index to its frame."""
    packs = spark.read.schema(_PACK_SCHEMA).parquet(f"{path}/packs").filter((F.col("first_doc_id") <= doc_id) & (F.col("last_doc_id") >= doc_id))
    return read(spark, path, packs).filter(F.col("doc_id") == doc_id)


def digest(docs: DataFrame, path: str | None = None, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files written for ``docs`` and read back."""
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark).rstrip('/')}/llm-tokens/{uuid.uuid4().hex}"
    write(docs, path, tokenizer, end_id)
    return _opened(spark, path, None, {"n_tokens": ("long", len), "ids_crc32": ("long", lambda x: zlib.crc32(x.tobytes()))})
