"""The pipeline's stages on a small table: columns, decisions that take effect, empty input."""

import corpus_pipeline
from meteoframe.llm import decontam, mixing, simhash, toxicity
from meteoframe.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = table(spark, SF, "documents")
    kept, counts = docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF)
        assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
        counts.append(kept.count())
    assert counts[1] <= counts[0] and counts[2] <= counts[1] and counts[3] <= counts[2]


def test_stages_equal_their_operators(spark):
    docs = table(spark, SF, "documents")
    classes = simhash.near_duplicates(docs).collect()
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()}
    assert kept == {r["component_id"] for r in classes}
    leaked = {r["doc_id"] for r in decontam.leaks(docs, table(spark, SF, "benchmark")).collect()}
    assert {r["doc_id"] for r in corpus_pipeline.drop_contaminated(spark, docs, SF).collect()} == {r["doc_id"] for r in classes} - leaked
    labels = table(spark, SF, "labels")
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.learn(docs, labels)).select("row.doc_id", "score").collect()}
    assert {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, SF).collect()} == {i for i, s in scores.items() if s < 0.7}
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
    mixed = [r["doc_id"] for r in corpus_pipeline.mix_sources(spark, docs, SF).collect()]
    assert all(mixed.count(i) == n for i, n in copies.items())


def test_run_and_empty_input(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    starts = sorted((r["start"], r["n_tokens"]) for r in rows)
    assert starts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
