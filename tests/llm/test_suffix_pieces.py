import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

from barflow.llm.suffix_pieces import MODEL, Decoder, Encoder, Vocabulary, decode, encode

from tests.llm.samples import SF_SMALL, odd_documents, with_clashes


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.load(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_ids_equal_the_library_on_hard_strings(vocabulary, library):
    rng = random.Random(3)
    alphabets = ["ab", "aaab ", "the ining er on", "0123456789 .,", "éèàü ßñ", "中文字符 と日本語 Ѐаб",
                 "\U0001f600\U0001f601 a\n\t\x00", "▁ a", "aeiouthn"]
    texts = ["", " ", "  ", "a", "<0x0A>", "<s> </s> <unk>", "x" * 500, "\n\n\n  \n", "hello world"]
    for _ in range(3000):
        letters = rng.choice(alphabets)
        texts.append("".join(rng.choice(letters) for _ in range(rng.randrange(40))))
    encoder, decoder = Encoder(vocabulary), Decoder(vocabulary)
    import numpy as np
    for text, got in zip(texts, encoder.encode(texts)):
        ids = np.frombuffer(got, dtype="<i4").tolist()
        assert ids == library.encode(text), repr(text)
        assert decoder.decode(ids) == text.replace("▁", " ")


def test_documents_equal_the_library_and_survive_the_round_trip(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = encode(docs).join(docs.select("doc_id", "text"), "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.token_ids == library.encode(r.text)
        assert r.round_trip and r.n_tokens == len(r.token_ids) and r.n_chars == len(r.text)
    back = encode(docs).select("doc_id", decode(F.col("token_ids")).alias("t")).join(docs, "doc_id")
    assert back.where("t <> text").count() == 0


def test_odd_rows(spark):
    docs = with_clashes(odd_documents(spark))
    rows = encode(docs).collect()
    assert len(rows) == docs.count() and all(r.round_trip for r in rows)
    assert {r.doc_id: r.n_tokens for r in rows}[1] == 0
    assert encode(docs.where(F.lit(False))).count() == 0


def test_idle_workers_hold_no_units(spark):
    docs = spark.createDataFrame([(i, f"word{i} of text {i * i}") for i in range(400)], "doc_id long, text string")
    assert encode(docs.coalesce(1)).count() == 400

    def held(batches):
        from barflow.llm import suffix_pieces

        known = sum(len(e.known) + len(e.older) + len(e.agreed) for e, _ in suffix_pieces._ready.values())
        for batch in batches:
            yield batch.assign(known=known)[["known"]]

    assert spark.range(64).repartition(4).mapInPandas(held, "known long").agg(F.max("known")).first()[0] == 0


def test_what_a_task_remembers_is_bounded(vocabulary, library, monkeypatch):
    monkeypatch.setattr("barflow.llm.suffix_pieces.KNOWN_UNITS", 50)
    encoder = Encoder(vocabulary)
    for at in range(0, 2000, 20):
        texts = [f"item{i} again{i % 7}" for i in range(at, at + 20)]
        assert [list(memoryview(c).cast("i")) for c in encoder.encode(texts)] == [library.encode(t) for t in texts]
    assert max(len(encoder.known), len(encoder.older), len(encoder.agreed) // 3) <= 60
