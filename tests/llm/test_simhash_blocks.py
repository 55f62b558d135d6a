import hashlib
import random

import xxhash
from pyspark.sql import functions as F

from barflow.llm import simhash_blocks as S
from barflow.llm.common import Scratch
from barflow.llm.links import signed
from tests.llm.samples import DOCS, odd_documents, with_clashes


def plain_edits(rows):
    """(doc_id, text) rows -> sorted (doc_id, n, sha of the edited text)."""
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for k, (i, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        new = t[:len(t) - half] + nxt[:half]
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest()))
    return sorted(out, key=str)


def test_weighted_votes():
    import math
    text = "The cat the cat the dog"
    terms = {"the cat": 2, "cat the": 2, "the dog": 1}
    votes = [0] * 64
    for term, n in terms.items():
        h = xxhash.xxh64_intdigest(term.encode())
        for b in range(64):
            votes[b] += (1 if h >> b & 1 else -1) * round(16 * (1 + math.log(n)))
    assert S.simhash(text) == sum(1 << b for b in range(64) if votes[b] > 0)
    assert S.simhash("") == S.simhash(None) == S.simhash(" \n") == 0
    assert S.likeness(5, 5) == 1.0 and S.likeness(0, -1) == 0.0


def test_edited_texts_match_a_plain_walk_over_many_runs(spark, monkeypatch):
    monkeypatch.setattr(S, "RUN_DOCS", 7)
    rng = random.Random(8)
    rows = [(rng.randrange(10 ** 12), "".join(rng.choice("ab é\U0001f600") for _ in range(rng.randrange(40))))
            for _ in range(200)]
    rows += [rows[0], (rows[1][0], "other"), (None, "no id"), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS).repartition(5)
    got = [(r.doc_id, r.n_chars, r.edited_sha256) for r in S.edited(docs).collect()]
    assert sorted(got, key=str) == plain_edits(rows)


def test_tables_find_every_fingerprint_within_the_radius(spark):
    rng = random.Random(3)
    values = set()
    for _ in range(40):
        c = rng.getrandbits(64)
        values |= {signed(c ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(5))})) for _ in range(6)}
    values = sorted(values)
    queries = values[::5]
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    got = {(r.query, r.fp, r.bits) for r in S.within(
        spark.createDataFrame([(q,) for q in queries], "fp long"), fps, radius=3, blocks=6).collect()}
    bits = lambda a, b: bin((a ^ b) & (2 ** 64 - 1)).count("1")
    assert got == {(q, v, bits(q, v)) for q in queries for v in values if bits(q, v) <= 3}
    root = {v: v for v in values}
    for _ in values:
        new = {v: min(root[w] for w in values if bits(v, w) <= 2) for v in values}
        if new == root:
            break
        root = new
    near = {r["fp"]: r["class"] for r in S.classes(fps, Scratch(spark, "t"), 2, 6, max_bucket=3).collect()}
    assert near == root


def test_odd_rows_and_likeness(spark):
    docs = with_clashes(odd_documents(spark))
    rows = S.fingerprints(docs).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows}
    assert by[1].fingerprint == by[2].fingerprint == "0" * 16 and by[1].near_edited == 1.0
    assert by[5].fingerprint == by[6].fingerprint
    assert all(0.0 <= r.near_edited <= 1.0 and 0.0 <= r.near_next <= 1.0 for r in rows)
    assert S.fingerprints(docs.where(F.lit(False))).count() == 0
    one = S.fingerprints(docs.where("doc_id = 4")).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"one"[:2] + b"o").hexdigest() and one[0].near_next == 1.0
