import corpus_pipeline
from ledgerloom.llm import exact_dedup, jaccard, langid


def test_pipeline_stage_by_stage(spark, small, documents):
    docs, columns = documents, documents.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.count()
        out = stage(spark, docs, small)
        if name != "packing":
            assert out.columns == columns
            out = corpus_pipeline.materialize(out, f"test-{name}")
            assert 0 < out.count() <= before
        if name == "language_id":
            assert out.count() >= 0.97 * before
        if name == "exact_dedup":
            assert exact_dedup.dedup_decisions(out).filter("group_size > 1").count() == 0
            assert out.count() == exact_dedup.dedup_decisions(docs).filter("kept").count()
        if name == "jaccard_join":
            components = jaccard.near_duplicates(docs).select("component_id").distinct().count()
            assert out.count() == components
        if name == "secret_scan":
            assert out.count() == before
        if name == "packing":
            assert {r[0] for r in out.select("doc_id").distinct().collect()} == {r[0] for r in docs.select("doc_id").collect()}
        docs = out
    run = corpus_pipeline.run(spark, small)
    assert {tuple(r) for r in run.select("doc_id", "piece", "ids_crc32").collect()} == {tuple(r) for r in docs.select("doc_id", "piece", "ids_crc32").collect()}


def test_pipeline_odd(spark, odd, small):
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, small), f"odd-{name}")
    assert docs.count() > 0


def test_language_stage_keeps_clean(spark, documents, small):
    kept = corpus_pipeline.language_id(spark, documents, small)
    assert kept.count() >= 0.97 * documents.count()
    assert langid.UNDETERMINED == "und"


def test_pipeline_empty(spark, empty, small):
    docs = empty
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small)
        assert name == "packing" or out.columns == empty.columns
        docs = corpus_pipeline.materialize(out, f"empty-{name}")
        assert docs.count() == 0
