"""The pipeline's stages on a small table, each against its own input."""

import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline as P
from barflow.llm import kneser_tables, simhash_pivots
from barflow.llm.secret_scan import find_spans
from barflow.llm.suffix_pieces import MODEL
from tests.llm.samples import SF_SMALL, odd_documents, with_clashes


def test_each_stage_acts_on_all_that_came_before(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    stages = dict(P.STAGES)
    assert list(stages) == ["toxicity", "simhash_near_dedup", "secret_scan", "mixing", "sentencepiece"]

    clean = stages["toxicity"](spark, docs, SF_SMALL).cache()
    model = kneser_tables.train(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    scores = {r.doc_id: r.score for r in kneser_tables.scored(docs, model).collect()}
    assert clean.columns == columns
    assert {r.doc_id for r in clean.collect()} == {i for i, s in scores.items() if s < 0.5}

    single = stages["simhash_near_dedup"](spark, clean, SF_SMALL).cache()
    groups = simhash_pivots.near_duplicates(clean).collect()
    assert single.columns == columns
    assert {r.doc_id for r in single.collect()} == {r.component_id for r in groups}

    masked = stages["secret_scan"](spark, single, SF_SMALL).cache()
    assert masked.columns == columns and masked.count() == single.count()
    before = {r.doc_id: r for r in single.collect()}
    found = {r.doc_id for r in find_spans(single, "f").where(F.size("f.base") + F.size("f.added") > 0).collect()}
    for r in masked.collect():
        assert ("[SECRET]" in r.text) == (r.doc_id in found)
        assert r.doc_id in found or r.text == before[r.doc_id].text
    assert find_spans(masked, "f").where(F.size("f.base") > 0).count() == 0

    mix = stages["mixing"](spark, masked, SF_SMALL).cache()
    assert mix.columns == columns and {r.doc_id for r in mix.collect()} == set(before)
    assert max(r["count"] for r in mix.groupBy("doc_id").count().collect()) <= 2

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r.doc_id: r.text for r in masked.collect()}
    tokens = stages["sentencepiece"](spark, mix, SF_SMALL).collect()
    assert len(tokens) == mix.count()
    assert all(r.round_trip and r.token_ids == library.encode(texts[r.doc_id]) for r in tokens)


def test_stages_survive_odd_rows(spark):
    docs = with_clashes(odd_documents(spark))
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL)
    assert docs.columns == with_clashes(odd_documents(spark)).columns
    empty = odd_documents(spark).where(F.lit(False))
    for name, stage in P.STAGES:
        assert stage(spark, empty, SF_SMALL).count() == 0
