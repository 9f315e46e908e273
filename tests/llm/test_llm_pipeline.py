"""The pipeline over sf0.001, stage by stage against the operators' own results."""

from pyspark.sql import functions as F

import corpus_pipeline
from forgestat.llm import registry
from forgestat.llm.common import table

SF = "/root/testdata/sf0.001"


def test_pipeline_and_stages(spark):
    docs = table(spark, SF, "documents")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == [
        "language_stage", "quality_stage", "ngram_stage", "decontamination_stage", "bpe_stage"]

    def kept(stage):
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes
        return {r.doc_id for r in out.select("doc_id").collect()}
    good = {r.doc_id for r in registry.op10_quality(spark, SF).collect() if r.predicted == 1}
    assert kept(corpus_pipeline.quality_stage) == good
    first = {r.component_id for r in registry.op2_ngram_jaccard(spark, SF).collect()}
    assert kept(corpus_pipeline.ngram_stage) == first
    leaked = {r.doc_id for r in registry.op1_decontamination(spark, SF).collect()}
    assert kept(corpus_pipeline.decontamination_stage) == ids - leaked
    lang = {r.doc_id for r in registry.op6_language_id(spark, SF).collect() if r.lang_pred != "und" and r.score >= 0.5}
    assert kept(corpus_pipeline.language_stage) == lang
    out = corpus_pipeline.run(spark, SF)
    coded = {r.doc_id: r for r in registry.op9_bpe(spark, SF).collect()}
    rows = out.collect()
    assert 0 < len(rows) == len({r.doc_id for r in rows}) < len(ids)
    assert all((r.n_tokens, r.ids_sha256, r.decoded_sha256) ==
               (coded[r.doc_id].n_tokens, coded[r.doc_id].ids_sha256, coded[r.doc_id].decoded_sha256) for r in rows)


def test_ngram_stage_judges_rows(spark):
    text = lambda tag: " ".join(f"{tag}{k}" for k in range(60))
    rows = [(3, text("a")), (5, text("a") + " more"), (5, text("b")), (7, text("c")), (7, text("d")),
            (8, text("e")), (8, text("e").upper()), (9, ""), (9, " "), (None, text("a")), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = [(r.doc_id, (r.text or "").lower().strip()) for r in corpus_pipeline.ngram_stage(spark, docs, SF).collect()]
    want = [(3, text("a")), (5, text("b")), (7, text("c")), (7, text("d")), (8, text("e")), (9, ""), (None, text("a")), (None, "")]
    assert sorted(out, key=str) == sorted(want, key=str)
    assert sorted(map(str, corpus_pipeline.ngram_stage(spark, docs.repartition(3), SF).collect())) == \
        sorted(map(str, corpus_pipeline.ngram_stage(spark, docs, SF).collect()))


def test_ngram_stage_keeps_clashing_columns(spark):
    """A column named like the stage's own numbers comes back as it was, where ids repeat."""
    text = lambda tag: " ".join(f"{tag}{k}" for k in range(60))
    rows = [(1, text("a"), 100, 1), (1, text("b"), 200, 2), (2, text("a"), 300, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row long, part int")
    got = sorted((r.doc_id, r._row, r.part) for r in corpus_pipeline.ngram_stage(spark, docs, SF).collect())
    assert got == [(1, 100, 1), (1, 200, 2)]


def test_stages_of_an_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0).withColumn("score", F.lit(1.0))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.collect() == []
    assert corpus_pipeline.bpe_stage(spark, docs, SF).collect() == []
