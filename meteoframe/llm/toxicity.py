"""Toxicity from class-conditional Kneser-Ney models over the letters of words.

Two models, toxic and ordinary, give the probability of each byte of a word
after the up to ``ORDER - 1`` bytes of the word before it. Both back off to one
shared model of all labelled text (interpolated Kneser-Ney with continuation
counts), so a rare expression that neither class knows costs both the same and
says nothing, while a rare form of a known one is still told by its beginning.

The difference of the two log-likelihoods is normalised for length: a text is
described by its three most toxic words, by what its words have above
``NEUTRAL`` in units of the square root of its length (the size of chance sums),
and by the logarithm of its length. A logistic fit turns these into a score from
0 to 1. It is made on a fifth of the labelled rows, with ratios counted on the
others; the ratios that score texts are then counted on all of them.

Counts cover every labelled training row and grow with the input. What tasks
receive is a table of every counted gram under its whole key, so a gram that was
never counted is told from all others. Only the logistic fit uses a bounded
sample: ``CALIBRATION_ROWS`` rows, chosen by hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .bytegrams import GramTable, chunks, gram_counts, gram_table, history, letters, suffix
from .common import map_batches, pieces, small_side, written

ORDER, NEUTRAL, DISCOUNT, CALIBRATION_ROWS = 7, 1.5, 0.75, 40_000

#: What describes a text: log-likelihood ratios of its three most toxic words, the excess of its words, its length.
FEATURES = ("first", "second", "third", "excess", "length")


def _shared(grams: DataFrame, order: int) -> DataFrame:
    """(gram, p): shared interpolated Kneser-Ney probability of the last byte of each gram of ``order`` bytes, from distinct grams one byte longer.

    Every length is written before the next one reads it: as one plan, all
    lengths would have some sixty shuffles, and the driver would hold, compile
    and adapt them together.
    """
    levels, longer = [], grams
    for size in range(order, 0, -1):
        longer = written(longer.groupBy(suffix("gram", size).alias("gram")).agg(F.count("*").alias("seen")), f"seen-{size}")
        levels.append((size, longer))
    below = None
    for size, level in reversed(levels):
        after = Window.partitionBy("h")
        here = level.withColumn("h", history("gram")).select(
            "gram", "seen", F.sum("seen").over(after).alias("all"), F.count("*").over(after).alias("kinds"))
        if below is None:
            here = here.withColumn("p_below", F.lit(1 / 256))
        else:
            here = here.withColumn("low", suffix("gram", size - 1)).join(below.select(F.col("gram").alias("low"), F.col("p").alias("p_below")), "low")
        below = written(here.select("gram", ((F.greatest(F.col("seen") - DISCOUNT, F.lit(0)) + DISCOUNT * F.col("kinds") * F.col("p_below")) / F.col("all")).alias("p")), f"shared-{size}")
    return below


def _class_ratio(counts: DataFrame, order: int) -> tuple[DataFrame, DataFrame]:
    """Log-likelihood ratios toxic/ordinary: (gram, llr) of known grams, (h, llr) of a new byte after a known history."""
    wide = written(counts.groupBy("gram").agg(*[F.sum(F.when(F.col("class") == c, F.col("n")).otherwise(0)).alias(f"c{c}") for c in (0, 1)]), "class-counts")
    after = Window.partitionBy("h")
    known = wide.withColumn("h", history("gram")).withColumn("low", suffix("gram", order - 1))
    for c in (0, 1):
        known = known.withColumn(f"t{c}", F.sum(f"c{c}").over(after)).withColumn(f"k{c}", F.sum((F.col(f"c{c}") > 0).cast("long")).over(after))
    known = known.join(_shared(wide.select("gram"), order - 1).select(F.col("gram").alias("low"), "p"), "low")

    def p(c: int, hits: Column, p_low: Column) -> Column:
        mixed = (F.greatest(hits - DISCOUNT, F.lit(0)) + DISCOUNT * F.col(f"k{c}") * p_low) / F.col(f"t{c}")
        return F.when(F.col(f"t{c}") > 0, mixed).otherwise(p_low)

    known = known.select("h", "gram", "t0", "t1", "k0", "k1",
                         F.log(p(1, F.col("c1"), F.col("p")) / p(0, F.col("c0"), F.col("p"))).alias("llr"))
    known = written(known, "class-ratio")
    new = known.select("h", "t0", "t1", "k0", "k1").distinct().select(
        "h", F.log(p(1, F.lit(0.0), F.lit(1.0)) / p(0, F.lit(0.0), F.lit(1.0))).alias("llr"))
    return known.select("gram", "llr"), new


@dataclass
class Model:
    """Frozen scores: tables of the ratios by gram and by history, and the logistic weights of the bias and ``FEATURES``."""

    known: GramTable
    new: GramTable
    weights: np.ndarray
    order: int = ORDER

    def features(self, texts: list[str | None]) -> np.ndarray:
        """[texts, features]; zeros for a text without letters."""
        top = np.full((len(texts), 3), -np.inf)
        excess, words = np.zeros(len(texts)), np.zeros(len(texts))
        for grams, owner, first in chunks((letters(t) for t in texts), self.order, by_word=True):
            if not len(grams):
                continue
            llr = self.known.find(grams)[:, 0].astype(np.float64)
            unknown = np.isnan(llr)
            if unknown.any():
                llr[unknown] = np.nan_to_num(self.new.find(grams[unknown] >> 8)[:, 0])
            word, of = np.add.reduceat(llr, first), owner[first]
            excess += np.bincount(of, weights=np.maximum(word - NEUTRAL, 0), minlength=len(texts))
            words += np.bincount(of, minlength=len(texts))
            order = np.lexsort((-word, of))
            rank = np.arange(len(of)) - np.searchsorted(of, of)
            best = np.full((len(texts), 3), -np.inf)
            for k in range(3):
                best[of[rank == k], k] = word[order[rank == k]]
            top = -np.sort(-np.concatenate([top, best], axis=1), axis=1)[:, :3]
        size = np.maximum(words, 1)
        return np.column_stack([np.where(np.isinf(top), 0.0, top), excess / np.sqrt(size), np.log(size)])

    def scores(self, texts: list[str | None]) -> np.ndarray:
        x = self.features(texts)
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-(self.weights[0] + x @ self.weights[1:])))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights (bias first) of a ridge logistic regression, by Newton steps on scaled features."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z / len(y) + ridge * np.eye(len(w)), z.T @ (p - y) / len(y) + ridge * w * np.r_[0, np.ones(len(w) - 1)])
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    slopes = w[1:] / scale
    return np.r_[w[0] - slopes @ mean, slopes]


def fit(train: DataFrame, order: int = ORDER, calibration_rows: int = CALIBRATION_ROWS) -> Model:
    """Model from (doc_id, text, toxic) rows. A fifth of them, by hash of the doc_id, calibrates the score against counts of the rest; the final counts are of all rows.

    Without rows of both classes every ratio is zero and the score is the share of toxic rows (0 if there are none).
    """
    train = written(train.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("toxic").cast("int")).filter("text is not null and toxic in (0, 1)")
                    .withColumn("part", F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(5))), "labelled")
    seen = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    blank = GramTable.of(np.zeros(0, dtype=np.int64), np.zeros((0, 1), dtype=np.float32))
    if len(seen) < 2:
        share = seen.get(1, 0) > 0
        return Model(blank, blank, np.r_[1000.0 if share else -1000.0, np.zeros(len(FEATURES))], order)
    parts = train.withColumn("class", F.col("toxic") + F.when(F.col("part") == 0, 2).otherwise(0))
    counts = written(gram_counts(parts, "text", "class", order, 4, by_word=True), "part-counts")
    model = _frozen(counts.filter("class < 2"), order)
    x, y = _calibration(train.filter("part = 0"), model, calibration_rows)
    if len(set(y.tolist())) < 2:  # too few labels for a left-out part
        x, y = _calibration(train, model, calibration_rows)
    model.weights = _logistic(x, y) if len(set(y.tolist())) == 2 else np.r_[np.log((seen[1] + 0.5) / (seen[0] + 0.5)), 1.0, np.zeros(len(FEATURES) - 1)]
    whole = _frozen(counts.withColumn("class", F.col("class") % 2), order)
    whole.weights = model.weights
    return whole


def _frozen(counts: DataFrame, order: int) -> Model:
    """Model of (gram, class, n), its weights still zero."""
    known, new = _class_ratio(counts, order)
    most = known.count()
    return Model(gram_table(known, "gram", ["llr"], most), gram_table(new, "h", ["llr"], most), np.zeros(1 + len(FEATURES)), order)


def _calibration(rows: DataFrame, model: Model, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of ``rows``; of more than ``most``, the first by hash of the doc_id."""
    marked = score(rows, model, features=True).select(*FEATURES, "row.toxic", F.xxhash64("row.doc_id").alias("h"))
    got = marked.orderBy("h", *FEATURES).limit(most).toArrow()
    return np.stack([got.column(c).to_numpy() for c in FEATURES], axis=1), got.column("toxic").to_numpy().astype(float)


def score(docs: DataFrame, model: Model, text_col: str = "text", features: bool = False) -> DataFrame:
    """(row, score): every row of ``docs`` as a struct, with its score (``FEATURES`` instead, if ``features``).

    Null and empty texts have zero features, so theirs is the score of a text that says nothing either way.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = [*FEATURES] if features else ["score"]

    def make():
        model = shared.value

        def batch(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in pieces(rows):
                texts = part.column(0).to_pylist()
                made = model.features(texts).T if features else [model.scores(texts)]
                yield pa.RecordBatch.from_arrays([part.column(1), *map(pa.array, made)], ["row", *out])
        return batch

    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return map_batches(rows, make, StructType([rows.schema["row"], *(StructField(c, DoubleType()) for c in out)]))


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves remainder ``fold``; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary")) % folds == fold, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Model of ``labels.toxic`` from the labelled documents outside the held-out third.

    Repeated labels of a document count as toxic if one of them does; null
    labels, ids and texts teach nothing.
    """
    marks = labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    marks = small_side(marks.filter(~held_out("doc_id", 3, 1)))
    return fit(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(marks, "doc_id"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``docs`` without the rows whose score is at least ``threshold``; the model learns from the labelled rows of ``docs`` itself."""
    return score(docs, learn(docs, labels)).filter(F.col("score") < threshold).select("row.*")
