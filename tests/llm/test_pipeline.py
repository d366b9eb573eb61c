"""The corpus pipeline: stage by stage against plain versions."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from folioflow.llm import decontam, toxicity
from folioflow.llm.common import table, word_count, written
from tests.llm import brute


def test_stages(spark, small):
    docs = table(spark, small, "documents")
    before = docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, before, small), name)
        kept[name] = (before, after)
        before = after
    columns = table(spark, small, "documents").columns
    assert all(after.columns == columns for name, (_, after) in kept.items() if name != "token_binary")

    first, clean = kept["toxicity"]
    field = toxicity.train(toxicity.sample(first, table(spark, small, "labels")))
    bad = {r.doc_id for r in toxicity.scored(first, field).collect() if r.score >= 0.5}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in first.collect()} - bad

    groups, unique = kept["near_duplicates"]
    # Alike means 0.8 of the five-word shingles.
    assert sorted(r.doc_id for r in unique.collect()) == sorted(set(brute.similar([(r.doc_id, r.text) for r in groups.collect()]).values()))

    unique, safe = kept["decontamination"]
    items = [decontam.normalised(r.text.encode()) for r in table(spark, small, "benchmark").collect()]
    leaking = {r.doc_id for r in unique.collect() if any(i in decontam.normalised(r.text.encode()) for i in items)}
    near = {r.doc_id for r in decontam.contaminated(unique, table(spark, small, "benchmark")).collect()}
    assert leaking <= near and {r.doc_id for r in safe.collect()} == {r.doc_id for r in unique.collect()} - near

    safe, mixed = kept["mixing"]
    size = lambda df, f=F.sum: {r.source: r.n for r in df.groupBy("source").agg(f(word_count(F.col("text"))).alias("n")).collect()}
    target, taken, largest = brute.targets(size(safe)), size(mixed), size(safe, F.max)
    assert all(abs(taken.get(s, 0) - t) <= 1.1 * largest[s] for s, t in target.items())

    mixed, packed = kept["token_binary"]
    rows = packed.orderBy("start").collect()
    assert len(rows) == mixed.count() and [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)
    assert np.array_equal(np.cumsum([0] + [r.n_tokens for r in rows])[:-1], [r.start for r in rows])


def test_odd_and_empty(spark, odd_docs, no_docs, small):
    plain = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for docs in (plain, plain.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, small)
        assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
        rows = docs.collect()
        # Of texts that are alike the one with the least id is left; what has no id stays.
        assert {r.doc_id for r in rows} <= {None, 1, 2, 4, 5, 8} and all(r.n_tokens >= 1 for r in rows)
