"""The pipeline's stages against plain Python on the rows each one got."""

import corpus_pipeline
from tallywing.llm import quality

SF = "/root/testdata/sf0.001"


def test_stages(spark, documents, tmp_path):
    from test_free import brute_components, check_packing

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = (before, docs)
        if name != names[-1]:
            assert docs.columns == documents.columns
    before, after = kept["quality_rules"]
    good = {r.doc_id for r in quality.quality_verdicts(before).filter("kept").collect()}
    assert {r.doc_id for r in after.collect()} == good
    before, after = kept["line_dedup"]
    assert after.count() == before.count() and all(r.n_chars == len(r.text) for r in after.collect())
    before, after = kept["ngram_jaccard_join"]
    want = {d for d, n, c in brute_components([(r.doc_id, r.text) for r in before.collect()]) if d == c}
    assert {r.doc_id for r in after.collect()} == want
    before, after = kept["harmonic_packing"]
    check_packing([(r.doc_id, r.text) for r in before.collect()], after.collect())
