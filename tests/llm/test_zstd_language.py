from pyspark.sql import functions as F

from barflow.llm.common import fold
from barflow.llm.zstd_language import PIECE_BYTES, Compressors, identify, learn
from tests.llm.samples import SF_LARGE, odd_documents, with_clashes


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_LARGE}/documents.parquet")
    learned = learn(docs)
    assert set(learned) == {"de", "en", "es", "fr"}
    rows = (docs.where(fold(F.col("doc_id"), 4) == 2)
            .select("lang", identify(F.col("text"), learned)["lang"].alias("p")).collect())
    assert sum(r.lang == r.p for r in rows) >= 0.97 * len(rows)


def test_held_out_rows_and_other_columns_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF_LARGE}/documents.parquet")
    changed = docs.withColumn("lang", F.when(fold(F.col("doc_id"), 4) == 2, "xx").otherwise(F.col("lang")))
    assert learn(changed) == learn(docs)


def test_whole_texts_count():
    tools = Compressors({"a": b"alpha beta gamma delta " * 40, "b": b"uno dos tres cuatro cinco " * 40})
    head, tail = "alpha beta gamma " * 300, "uno dos tres cuatro " * 3000
    assert len(head) > PIECE_BYTES
    assert tools.judge(head)[0] == "a" and tools.judge(head + tail)[0] == "b"
    assert tools.judge("123 !!") == tools.judge(None) == tools.judge("") == ("und", 0.0, 0.0)
    lang, score, margin = tools.judge("alpha beta gamma delta alpha")
    assert lang == "a" and 0.5 < score <= 1 and margin > 0
    assert Compressors({}).judge("word")[0] == "und"


def test_odd_rows(spark):
    docs = with_clashes(odd_documents(spark))
    for learned in (learn(docs), learn(docs.where(F.lit(False)))):
        rows = docs.select("doc_id", identify(F.col("text"), learned).alias("j")).collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert r.j.lang in {*learned, "und"} and 0.0 <= r.j.score <= 1.0
    assert docs.where(F.lit(False)).select(identify(F.col("text"), {})).count() == 0
