import math
import random

import numpy as np
from pyspark.sql import functions as F

from barflow.llm import kneser_tables
from barflow.llm.common import Scratch, fold
from barflow.llm.kneser_tables import (DISCOUNTS, PAIR_DISCOUNTS, Model, count, evidence, of_texts, scored,
                                       tabled_ratios, train, weighed)
from tests.llm.samples import DOCS, SF_LARGE, SF_SMALL, odd_documents, with_clashes

LABELS = "doc_id long, quality int, toxic int"


def plain_evidence(texts, asked):
    """The module's formulas word by word over dictionaries."""
    n, k, both = [{}, {}], [{}, {}], {}
    for text, t in texts:
        w = text.split()
        for hx in set(zip([None, *w], w)):
            n[t][hx] = n[t].get(hx, 0) + 1
    for t in (0, 1):
        for _, x in n[t]:
            k[t][x] = k[t].get(x, 0) + 1
    for _, x in set(n[0]) | set(n[1]):
        both[x] = both.get(x, 0) + 1

    def low(c, x, d):
        left = max(sum(min(v, d) for v in k[t].values()) / sum(k[t].values()) for t in (0, 1))
        return (max(k[c].get(x, 0) - d, 0) / sum(k[c].values())
                + left * (both.get(x, 0) + 1) / (sum(both.values()) + len(both) + 1))

    def share(c, h, e):
        of = [v for (g, _), v in n[c].items() if g == h]
        return sum(min(v, e) for v in of) / sum(of) if of else 1.0

    def high(c, h, x, d, e):
        total = sum(v for (g, _), v in n[c].items() if g == h)
        direct = max(n[c].get((h, x), 0) - e, 0) / total if total else 0.0
        return direct + max(share(t, h, e) for t in (0, 1)) * low(c, x, d)

    w = asked.split()
    out = [np.array([math.log(low(1, x, d) / low(0, x, d)) for x in w]) for d in DISCOUNTS]
    for e in PAIR_DISCOUNTS:
        for d in DISCOUNTS:
            out.append(np.array([math.log(high(1, h, x, d, e) / high(0, h, x, d, e)) for h, x in zip([None, *w], w)]))
    return [v for r in out for v in (evidence(r), r.mean() if len(w) else 0.0)] + [math.log1p(len(w))]


def test_evidence_matches_plain_class_conditional_counts(spark):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(30)]
    texts = [(" ".join(rng.choice(vocabulary) for _ in range(40)) + (" vile scum vile scum" if t else ""), t)
             for t in [0, 1, 0, 0, 1] * 6]
    model = count(spark.createDataFrame(texts, "text string, toxic int"), Scratch(spark, "t"))
    asked = [texts[0][0], texts[1][0], "w1 w2 never seen vile scum w3", "", "never seen at all"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(asked)], "i int, text string")
    out, features = weighed(frame, model)
    got = out.collect()
    assert len(got) == len(asked)
    n = len(DISCOUNTS)
    for row in got:
        plain = plain_evidence(texts, asked[row.i])
        assert np.allclose(row[features], plain, rtol=1e-9, atol=1e-9)
        # the table of one D and E, with what has no effect left out, gives the same
        for d in (0, 2):
            for e in range(len(PAIR_DISCOUNTS)):
                table = model.ratios(DISCOUNTS[d], PAIR_DISCOUNTS[e]).toPandas().sort_values("key")
                known = {c: table[c].to_numpy() for c in table}
                at = 2 * (n * (e + 1) + d)
                want = [*plain[2 * d:2 * d + 2], *plain[at:at + 2], plain[-1]]
                short = of_texts([asked[row.i]], kneser_tables.WordKeys(), lambda h, w: tabled_ratios(h, w, known))
                assert np.allclose(short[0], want, rtol=1e-9, atol=1e-9)


def test_an_expression_of_ordinary_words_is_found(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(40)]

    def text(toxic):
        w = [rng.choice(vocabulary) for _ in range(60)]
        # both words three times in every text, next to each other in the toxic ones
        for at in (5, 25, 45):
            w[at:at + 4] = ["cold", "fish", "w0", "w1"] if toxic else ["cold", "w0", "fish", "w1"]
        return " ".join(w)

    docs = spark.createDataFrame([(i, text(i % 4 == 0), "en", "s", 1) for i in range(1500)], DOCS)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(1500)], LABELS)
    rows = (scored(docs, train(docs, labels)).where(fold(F.col("doc_id"), 5) == 0)
            .select("doc_id", "score").collect())
    assert len(rows) > 200
    assert sum((r.score >= 0.5) == (r.doc_id % 4 == 0) for r in rows) >= 0.98 * len(rows)


def test_every_pair_is_kept_however_many_there_are(spark):
    # 260,000 distinct pairs, each in two documents, and more words than 2^18 ids keep apart
    rows = [(i, " ".join(f"x{(i // 2) * 1300 + j}" for j in range(1300)), "en", "s", 1) for i in range(400)]
    rows += [(1000 + i, "vile scum", "en", "s", 1) for i in range(3)]
    docs = spark.createDataFrame(rows, DOCS).select("text", (F.col("doc_id") >= 1000).cast("int").alias("toxic"))
    model = count(docs, Scratch(spark, "t"))
    assert model.pairs.count() == 200 * 1300 + 2
    assert model.words.count() == 200 * 1300 + 2 + 1       # and the start
    assert model.vocabulary == 200 * 1300 + 2


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_LARGE}/documents.parquet")
    labels = spark.read.parquet(f"{SF_LARGE}/labels.parquet")
    rows = (scored(docs, train(docs, labels)).join(labels, "doc_id").where(fold(F.col("doc_id"), 5) == 0)
            .select("toxic", (F.col("score") >= 0.5).cast("int").alias("p")).collect())
    assert sum(r.toxic == r.p for r in rows) >= 0.95 * len(rows)
    toxic = [r.p for r in rows if r.toxic == 1]
    assert sum(toxic) >= 0.8 * len(toxic)


def test_odd_rows_small_chunks_and_both_ways_to_the_table(spark):
    docs = with_clashes(odd_documents(spark))
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(1, 12)] + [(None, 1, 1), (3, None, None)], LABELS)
    models = [train(docs, labels), train(docs, labels.where("toxic = 0")), train(docs.where(F.lit(False)), labels)]
    assert isinstance(models[0], Model) and models[1] is None and models[2] is None
    seen = []
    for size, rows in ((kneser_tables.CHUNK, kneser_tables.TABLE_ROWS), (kneser_tables.CHUNK, 0), (1, 0)):
        for model in models:
            out = scored(docs, model, "of_text", size=size, table_rows=rows)
            assert out.columns == [*docs.columns, "of_text"]
            got = out.collect()
            assert len(got) == docs.count() and all(0.0 <= r.of_text <= 1.0 for r in got)
            assert {(r.doc_id, r.text) for r in got} == {(r.doc_id, r.text) for r in docs.collect()}
            seen.append(sorted((str(r.doc_id), str(r.text), round(r.of_text, 9)) for r in got))
    assert seen[:3] == seen[3:6] == seen[6:]
    for rows in (0, 1000):
        assert scored(docs.where(F.lit(False)), models[0], table_rows=rows).count() == 0


def test_shuffled_input_is_scored_either_way(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    want = {r.doc_id: round(r.score, 9) for r in scored(docs, model).collect()}
    assert len(want) == docs.count()
    for rows in (0, kneser_tables.TABLE_ROWS):
        for moved in (docs.repartition(5), docs.dropDuplicates(["text"])):
            got = scored(moved, model, table_rows=rows, size=1 << 16).collect()
            assert all(round(r.score, 9) == want[r.doc_id] for r in got) and len(got) == moved.count()
