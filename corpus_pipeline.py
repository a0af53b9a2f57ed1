"""Corpus pipeline: toxicity, near-duplicates, decontamination, mixing, token output.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, and each stage works on what its predecessor kept.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meteoframe.llm import decontam, mixing, simhash, token_output, toxicity
from meteoframe.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.7 or more go; labels of the held-out third teach nothing."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), threshold=0.7)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: 4-word shingles, links at 4 or fewer differing bits."""
    return simhash.one_of_each(docs, shingle=4, max_bits=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item, literal or re-parameterised, go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the cube method takes it: sources weigh 3, 1, 2 in turn, 150 % of all words, at most 2 times a source."""
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs of token ids; returns doc_id, start, n_tokens, ids_crc32 of every document as read back from them."""
    return token_output.digest(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token output", write_tokens),
]

#: The stages hash, train and sample; they are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table, each written as Parquet and reread as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
