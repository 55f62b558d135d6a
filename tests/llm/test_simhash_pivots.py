import random

import xxhash
from pyspark.sql import functions as F

from barflow.llm.common import Scratch
from barflow.llm.links import MASK64, bucket_links, components, dense_links, signed
from barflow.llm.simhash_pivots import (keep_first, majority_bits, near_duplicates, pivot_keys,
                                        within_coordinates)
from tests.llm.samples import DOCS, odd_documents, with_clashes


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", lower)]
    if not words:
        return 0
    grams = ([" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
             if len(words) >= 3 else [" ".join(words)])
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def reach(values, radius):
    """node -> smallest reachable value, by brute force."""
    root = {v: v for v in values}
    changed = True
    while changed:
        changed = False
        for v in values:
            for w in values:
                if bin((v ^ w) & MASK64).count("1") <= radius and root[w] < root[v]:
                    root[v], changed = root[w], True
    return root


def test_fingerprint_is_the_majority_of_shingle_hashes():
    for t in ["", None, "a", "A b", "x y z", "the cat sat on the mat " * 9, "é ü ß\x0bq\x1cz"]:
        assert majority_bits(t) == plain_fingerprint(t)


def clustered(seed=1):
    rng, out = random.Random(seed), set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(25):
            out.add(centre ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(4))}))
    return [signed(x) for x in out] + [0, 1, signed(-1)]


def test_groups_equal_brute_force_for_small_and_crowded_buckets(spark):
    values = clustered()
    fps = spark.createDataFrame([(v,) for v in set(values)], "fp long")
    want = reach(list(set(values)), 2)
    for most in (2, 10_000):
        s = Scratch(spark, "t")
        links = bucket_links(s, fps, pivot_keys(fps, 2, 6), 2, within_coordinates(2), most)
        got = {r.node: r.root for r in components(s, links).collect()}
        assert {v: got.get(v, v) for v in want} == want


def test_dense_links_for_odd_radius(spark):
    values = list({v & 0xFFFF for v in clustered(3)})[:60]
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    got = {r.node: r.root for r in components(Scratch(spark, "t"), dense_links(fps, 3)).collect()}
    want = reach(values, 3)
    assert {v: got.get(v, v) for v in values} == want


def test_documents_against_brute_force(spark):
    rng = random.Random(5)
    base = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(60)) for _ in range(8)]
    rows = []
    for i in range(80):
        words = base[i % 8].split()
        if i >= 24:
            words[rng.randrange(60)] = "zz"
        rows.append((i, " ".join(words), "en", "s", 1))
    got = {r.doc_id: r for r in near_duplicates(spark.createDataFrame(rows, DOCS)).collect()}
    fp = {i: plain_fingerprint(t) for i, t, *_ in rows}
    roots = {i: i for i in fp}
    for _ in fp:
        for i in fp:
            roots[i] = min(roots[j] for j in fp if bin(fp[i] ^ fp[j]).count("1") <= 2)
    assert {i: r.component_id for i, r in got.items()} == roots
    assert all(r.fingerprint == format(fp[i], "016x") for i, r in got.items())


def test_odd_rows_have_defined_results(spark):
    docs = with_clashes(odd_documents(spark))
    rows = near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows}
    assert {by[i].component_id for i in (1, 2, 3)} == {1} and by[1].fingerprint == "0" * 16
    assert by[5].component_id == by[6].component_id == 5 and by[None].component_id is None
    kept = keep_first(docs)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 5, 7, 8, 9]
    assert kept.columns == docs.columns
    assert near_duplicates(docs.where(F.lit(False))).count() == 0
