"""Language identification by prediction by partial matching (PPM, escape method C).

Each language has a byte context tree of depth ``ORDER``, counted over all
training text and then frozen. A byte that its deepest context has seen n times
costs -log2(n / (total + kinds)) bits; else the context's escape,
-log2(kinds / (total + kinds)), is paid and the next shorter context is asked,
down to the order-0 context and 8 bits for a byte that the language has never
shown. A context that the language has never met costs nothing to leave. The
language with the shortest code for the whole text wins.

Since the statistics are frozen, the cost of each (context, byte) under every
language is worked out once, in Spark joins from the deepest counts; tasks get
one table per order, by whole gram, with the costs of all languages side by side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .bytegrams import GramTable, chunks, gram_counts, gram_table, history, letters, suffix
from .common import map_batches, pieces, written

ORDER, MOST_LANGUAGES = 4, 200


@dataclass
class Model:
    """languages; per order k >= 1 the costs of known (context, byte) and of leaving a known context, by language; order 0 [byte, language]."""

    languages: list[str]
    costs: dict[int, GramTable]
    leave: dict[int, GramTable]
    zero: np.ndarray
    order: int = ORDER

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """[bytes, languages]: code length of the last byte of each gram."""
        out = self.costs[self.order].find(grams).astype(np.float32)
        todo = np.flatnonzero(np.isnan(out[:, 0]))
        if len(todo):
            out[todo] = 0
            for k in range(self.order, -1, -1):
                if not len(todo):
                    break
                part = grams[todo] & ((1 << 8 * (k + 1)) - 1)
                got = self.costs[k].find(part) if k else self.zero[part]
                new = np.isnan(got[:, 0])
                out[todo[~new]] += got[~new]
                todo = todo[new]
                if k and len(todo):
                    out[todo] += np.nan_to_num(self.leave[k].find(part[new] >> 8))
        return out

    def lengths(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """([texts, languages] code lengths in bits, [texts] bytes)."""
        total, size = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        for grams, owner, _ in chunks((letters(t) for t in texts), self.order + 1):
            bits = self.bits(grams)
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            total[owner[starts]] += np.add.reduceat(bits, starts, axis=0, dtype=np.float64)
            size[owner[starts]] += np.diff(np.append(starts, len(owner)))
        return total, size


def fit(train: DataFrame, order: int = ORDER, text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Model from all rows with a text and a language; None if there are none."""
    rows = train.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("text is not null and lang is not null")
    languages = sorted(r[0] for r in rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if not languages:
        return None
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    number = F.create_map(*[F.lit(x) for i, name in enumerate(languages) for x in (name, i)])
    counts = gram_counts(rows.withColumn("class", F.element_at(number, F.col("lang"))), "text", "class", order + 1, len(languages))
    span = range(len(languages))
    deepest = written(counts.groupBy("gram").agg(*[F.sum(F.when(F.col("class") == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in span]), "language-counts")
    costs: dict[int, GramTable] = {}
    leave: dict[int, GramTable] = {}
    below, zero = None, np.full((256, len(languages)), np.nan, dtype=np.float32)
    for k in range(order + 1):  # contexts of k bytes, grams of k + 1
        level = deepest if k == order else deepest.groupBy(suffix("gram", k + 1).alias("gram")).agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in span])
        after = Window.partitionBy("h")
        level = level.withColumn("h", history("gram") if k else F.lit(0).cast("long"))
        level = level.select("*", *[F.sum(f"n{i}").over(after).alias(f"t{i}") for i in span], *[F.sum((F.col(f"n{i}") > 0).cast("int")).over(after).alias(f"k{i}") for i in span])
        if below is None:
            level = level.select("*", *[F.lit(8.0).alias(f"b{i}") for i in span])
        else:
            level = level.withColumn("low", suffix("gram", k)).join(below.select(F.col("gram").alias("low"), *[F.col(f"x{i}").alias(f"b{i}") for i in span]), "low")
        here = F.expr
        level = written(level.select(
            "gram", "h",
            *[here(f"case when t{i} = 0 then b{i} when n{i} > 0 then -log2(n{i} / (t{i} + k{i})) else b{i} - log2(k{i} / (t{i} + k{i})) end").alias(f"x{i}") for i in span],
            *[here(f"case when t{i} = 0 then 0 else -log2(k{i} / (t{i} + k{i})) end").alias(f"e{i}") for i in span]), f"language-order{k}")
        below = level.select("gram", *[f"x{i}" for i in span])
        if k:
            most = level.count()
            costs[k] = gram_table(level, "gram", [f"x{i}" for i in span], most, np.float32)
            leave[k] = gram_table(level.groupBy("h").agg(*[F.first(f"e{i}").alias(f"e{i}") for i in span]), "h", [f"e{i}" for i in span], most, np.float32)
        else:
            for r in level.collect():  # 256 bytes at most
                zero[r["gram"]] = [r[f"x{i}"] for i in span]
            none = level.select(*[f"e{i}" for i in span]).first()
            zero[np.isnan(zero[:, 0])] = np.array([none[f"e{i}"] + 8.0 for i in span]) if none else 8.0
    return Model(languages, costs, leave, zero, order)


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """(row, lang_pred, score): every row of ``docs`` as a struct with its language and the posterior of that language.

    ``und`` and 0 if the text is null, has no letter, or nothing was learned; equal code lengths go to the first language by name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value

        def batch(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in pieces(rows):
                n = part.num_rows
                names, scores = np.full(n, "und", dtype=object), np.zeros(n)
                if model is not None:
                    bits, size = model.lengths(part.column(0).to_pylist())
                    some = np.flatnonzero(size > 0)
                    best = bits[some].argmin(axis=1)
                    names[some] = np.array(model.languages, dtype=object)[best]
                    scores[some] = 1 / np.exp2(np.maximum(bits[some, best][:, None] - bits[some], -1000)).sum(axis=1)
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(names, pa.string()), pa.array(scores)], ["row", "lang_pred", "score"])
        return batch

    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return map_batches(rows, make, StructType([rows.schema["row"], StructField("lang_pred", StringType()), StructField("score", DoubleType())]))
