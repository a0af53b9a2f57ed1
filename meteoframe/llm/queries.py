"""The registered queries of this subpackage: thin contracts over the operators, on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import ann, decontam, html_extract, importance, langid, member_lloyd, mixing, pii, simhash, token_counts, token_output, toxicity, voronoi
from .common import table


def op1_cross_polytope_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: the 20 nearest found of every row whose vec_id is divisible by 20, among all other rows."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)


def op2_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, section, first_char, n_chars, n_tokens of every line section; a token that crosses a boundary counts where it starts."""
    return token_counts.section_tokens(table(spark, sf_dir, "documents"), rule="start")


def op3_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, first_word, last_word, windows, reparameterised: documents that share a consistent run of 13 template words with a benchmark item."""
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document (and its source)."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


def op5_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every document: 4-word shingles, links at 4 or fewer differing bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text, n_entities of every document, personal data replaced by keyed surrogates."""
    return pii.replaced(table(spark, sf_dir, "documents"))


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the written packs."""
    return token_output.digest(table(spark, sf_dir, "documents"))


def op8_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op9_toxicity_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; labels of the held-out third teach nothing."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("row.doc_id", toxicity.held_out("row.doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_langid_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; rows of the held-out quarter teach nothing."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = langid.fit(docs.filter(~toxicity.held_out("doc_id", 4, 2)))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("row.doc_id", toxicity.held_out("row.doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def op11_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: the 5 largest integer inner products of every row whose vec_id is divisible by 50, among all other rows."""
    return voronoi.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, 5)


def op12_member_lloyd_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every valid row: 16 parts, 64 entries, 2 rounds."""
    return member_lloyd.compress(table(spark, sf_dir, "embeddings"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document: 5 % drawn towards the benchmark's features."""
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {f.__name__: f for f in (
    op1_cross_polytope_ann, op2_section_tokens, op3_template_decontamination, op4_cube_mixing, op5_simhash_neardup, op6_pii_surrogates,
    op7_token_output, op8_html_main_text, op9_toxicity_kneser_ney, op10_langid_ppm, op11_voronoi_knn, op12_member_lloyd_codes,
    op13_importance_resampling,
)}
ORACLE: dict[str, str] = {}
