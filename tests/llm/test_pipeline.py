"""The pipeline stage by stage, each against what its input says."""

import corpus_pipeline
from namepulse.llm import decontam, jaccard, linededup, quality
from namepulse.llm.tables import documents, settle

SF = "/root/testdata/sf0.001"


def test_stages_act_on_their_own_input(spark):
    docs = documents(spark, SF)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, settle(stage(spark, docs, SF), "test-stage")
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "packing":
            tokens = docs.groupBy("doc_id").sum("length").count()
            assert tokens == before.count()
            continue
        assert docs.columns == columns
        if name == "quality rules":
            assert ids == {r.doc_id for r in quality.judge(before).where("kept").collect()}
        elif name == "line dedup":
            assert ids == {r.doc_id for r in before.select("doc_id").collect()}
            index = linededup.build(docs, least=corpus_pipeline.REPEATED_IN)
            assert index.counts.where("docs >= 10").isEmpty()
        elif name == "n-gram Jaccard join":
            groups = jaccard.link_groups(before, size=5, percent=80).collect()
            assert ids == {r.component_id for r in groups}
        else:
            leaks = decontam.leaks(before, documents(spark, SF, "benchmark")).collect()
            assert ids == {r.doc_id for r in before.select("doc_id").collect()} - {r.doc_id for r in leaks}


def test_run_gives_the_last_stage(spark):
    assert {"doc_id", "sequence_id", "offset"} <= set(corpus_pipeline.run(spark, SF).columns)
