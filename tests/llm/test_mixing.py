import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from barflow.llm.mixing import mixed, n_tokens, realise
from tests.llm.samples import DOCS, odd_documents, with_clashes


def corpus(spark, seed=4):
    rng, rows = random.Random(seed), []
    for i in range(600):
        source = "hot" if i % 3 == 0 else f"s{rng.randrange(7)}"
        rows.append((i, "w " * rng.randrange(1, 40), "en", source, 1))
    return spark.createDataFrame(rows, DOCS), rows


def tokens_by_source(rows):
    out = defaultdict(int)
    for r in rows:
        out[r[3]] += len(r[1].split())
    return out


def test_repetition_limit_is_met_and_every_document_stays(spark):
    docs, rows = corpus(spark)
    have = tokens_by_source(rows)
    total = sum(have.values())
    got = realise(docs, max_epochs=2.0, block_tokens=100).collect()
    assert {r.doc_id for r in got} == {r[0] for r in rows}
    assert len({(r.doc_id, r.epoch) for r in got}) == len(got)
    took = defaultdict(int)
    for r in got:
        took[r.source] += r.tokens
    hot, small = max(have.values()), min(have.values())
    u = min(1.0, math.log(2) / math.log(hot / small))     # the exact answer of the search
    for s, n in have.items():
        quota = n * (n / hot) ** -u
        assert quota - 1e-3 * total <= took[s] <= quota + 40
    weights = {r.source: r.weight for r in got}
    z = sum((n / total) ** (1 - u) for n in have.values())
    for s, n in have.items():
        assert weights[s] == pytest.approx((n / total) ** (1 - u) / z, rel=1e-5)


def test_entropy_target_and_budget(spark):
    docs, rows = corpus(spark, 9)
    have = tokens_by_source(rows)
    got = realise(docs, max_epochs=None, entropy=0.97, budget=3000, block_tokens=50).collect()
    weights = {r.source: r.weight for r in got}
    h = -sum(w * math.log(w) for w in weights.values())
    assert h == pytest.approx(0.97 * math.log(len(have)), rel=1e-4)
    took = Counter()
    for r in got:
        took[r.source] += r.tokens
    for s, w in weights.items():
        assert 3000 * w - 1e-6 <= took[s] <= 3000 * w + 40


def test_blocks_of_an_epoch_stay_together_and_orders_differ(spark):
    docs, _ = corpus(spark)
    got = realise(docs, max_epochs=3.0, block_tokens=200).collect()
    orders = defaultdict(list)
    for r in sorted(got, key=lambda r: r.slot):
        assert 0 <= r.slot <= 1
        orders[(r.source, r.epoch)].append(r.block)
    firsts = [tuple(dict.fromkeys(v)) for v in orders.values() if len(set(v)) > 2]
    assert len(set(firsts)) > 1


def test_token_count_matches_python(spark):
    texts = ["", None, " ", "a", " a  b\tc\n", "\x0b\x0cx\x1cy z"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    want = [len([w for w in __import__("re").split(r"[\x20\x09-\x0D]+", t or "") if w]) for t in texts]
    assert [r[0] for r in df.select(n_tokens(F.col("text"))).collect()] == want


def test_odd_rows(spark):
    docs = with_clashes(odd_documents(spark))
    out = mixed(docs)
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()}
    assert mixed(docs.where(F.lit(False))).count() == 0
    assert mixed(docs.where("doc_id = 1")).count() == 1
