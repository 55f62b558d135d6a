"""Groups against all pairs of full sets."""

import random
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from barflow.llm import minhash_stars
from barflow.llm.minhash_stars import BINS, near_duplicates, one_permutation, parity_map, shingles
from barflow.llm.queries import op11_minhash_stars
from tests.llm.samples import SF_MID, odd_documents, with_clashes


def word_sets(rows, k=5):
    out = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        out.append(frozenset(b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset())
    return out


def expected(rows, percent=85):
    """Each row's (doc_id, n_shingles, component_id, kept), sorted, by comparing all sets that share a shingle."""
    sets = word_sets(rows)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders, first = {}, {}
    for i, s in enumerate(sets):
        if not s:
            continue
        if s in first:
            parent[i] = first[s]
            continue
        first[s] = i
        shared = {}
        for g in s:
            for j in holders.setdefault(g, []):
                shared[j] = shared.get(j, 0) + 1
            holders[g].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            best[find(i)] = min(best.get(find(i), d), d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = best.get(find(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_equals_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect()]
    out = op11_minhash_stars(spark, SF_MID)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert got(out) == expected(rows)


def chains(rng, groups, size):
    """Texts edited from one another, so that few are linked with a group's centre."""
    rows = []
    for g in range(groups):
        shared = [f"p{rng.randrange(300)}" for _ in range(rng.choice([0, 60]))]
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(4, 90))]
        texts = [words]
        for _ in range(size):
            w = list(rng.choice(texts[-3:]))
            for _ in range(rng.choice([0, 1, 1, 2])):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
            if rng.random() < .2:
                w = w[:max(3, int(len(w) * .93))]
            texts.append(w)
        rows += [" ".join(shared + w) for w in texts]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_chains_and_copies_lose_no_link(spark):
    rows = chains(random.Random(8), 12, 60)
    rows += [(1000 + i, rows[5][1].upper()) for i in range(50)] + [(2000, ""), (2001, None), (2002, " ")]
    assert got(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == expected(rows)


def test_partners_of_the_hub_and_others_are_still_compared(spark):
    """The hub's partner x is linked with y, the hub is not: the star alone would part them."""
    base = [f"w{i}" for i in range(200)]

    def edited(*places):
        return " ".join("x" * 3 + str(i) if i in places else w for i, w in enumerate(base))

    x, y = edited(10, 60), edited(10, 60, 110, 150)
    sets = word_sets([(0, " ".join(base)), (1, x), (2, y)])
    alike = {p: len(sets[p[0]] & sets[p[1]]) / len(sets[p[0]] | sets[p[1]]) for p in combinations(range(3), 2)}
    assert alike[0, 1] >= .85 and alike[1, 2] >= .85 and alike[0, 2] < .85
    rows = [(i, " ".join(base)) for i in range(5, 9)] + [(1, x), (2, y)]
    rows += [(100 + i, edited(*range(i % 7, 200, 23))) for i in range(7)]
    assert got(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == expected(rows)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(near_duplicates(with_clashes(docs))) == expected(rows)
    assert near_duplicates(docs.where(F.lit(False))).count() == 0
    twice = docs.unionByName(docs)
    assert got(near_duplicates(twice)) == expected(rows + rows)


def test_sketches():
    rng = random.Random(9)
    words = [f"w{rng.randrange(10 ** 6)}" for _ in range(404)]
    for n in (1, 3, 6, 50, 400):
        a = shingles(" ".join(words[:n + 4]))
        b = shingles(" ".join(words[:n + 4] + ["more"]))
        shared = len(set(a) & set(b)) / len(set(a) | set(b))
        assert len(a) == n
        same = np.mean(one_permutation(a) == one_permutation(b))
        assert abs(same - shared) < 6 * (0.25 / min(n, BINS)) ** .5
        apart = np.bitwise_count((parity_map(a) ^ parity_map(b)).view(np.uint64)).sum()
        assert apart <= len(set(a) ^ set(b))
    assert len(set(minhash_stars.bucket_keys(shingles("one")))) == minhash_stars.BANDS
