import numpy as np
from pyspark.sql import functions as F

from barflow.llm.pruned_graph import build_graph, robust_prune, search
from tests.llm.samples import SF_LARGE

VECS = "vec_id long, embedding array<float>, label int"


def brute(rows, k, is_query=lambda i: i % 20 == 0):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    out = {}
    for i, v in zip(ids, x):
        if is_query(i):
            s = (x * v).sum(axis=1)
            keep = ids != i
            o = np.lexsort((ids[keep], -s[keep]))[:k]
            out[int(i)] = list(zip(ids[keep][o].tolist(), s[keep][o].tolist()))
    return out


def test_small_table_is_answered_exactly_with_ties(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(60, 8)).astype(np.float32)
    rows = [(i, [float(a) for a in base[i % 60 if i < 240 else 7]]) for i in range(400)]
    got = {}
    for r in search(spark.createDataFrame([(i, v, 0) for i, v in rows], VECS), k=20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute(rows, 20)
    assert got.keys() == want.keys()
    for q, hits in want.items():
        assert [h[0] for h in got[q]] == list(range(1, 21))
        assert [h[1] for h in got[q]] == [i for i, _ in hits]
        assert np.allclose([h[2] for h in got[q]], [s for _, s in hits], atol=1e-12)


def test_recall_on_the_table_over_several_shards(spark):
    vectors = spark.read.parquet(f"{SF_LARGE}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in vectors.collect()]
    want, hit, n = brute(rows, 20), 0, 0
    got = {}
    for r in search(vectors, shard_rows=700).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    for q, hits in want.items():
        assert len(got[q]) == 20
        hit += sum(i in got[q] for i, _ in hits)
        n += len(hits)
        for i, s in hits:
            assert abs(got[q].get(i, s) - s) < 1e-9
    assert hit >= 0.9 * n


def test_prune_keeps_the_nearest_and_diverse(spark):
    x = np.array([[0, 0], [1, 0], [1.1, 0], [0, 2]], dtype=np.float32)
    out = robust_prune(x, np.array([0]), np.array([[1, 2, 3, -1]]), 3, 1.0)
    assert out.tolist() == [[1, 3, -1]]
    graph, _ = build_graph(np.zeros((1, 2), np.float32), 4, 8, 1.2)
    assert (graph == -1).all()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 0), (20, [0.5, 0.5], None), (1, [0.9, 0.1], 0), (1, [0.9, 0.1], 0), (2, None, 0),
            (3, [0.0, 0.0], 0), (4, [nan, 1.0], 0), (5, [inf, 1.0], 0), (6, [None, 1.0], 0), (7, [], 0),
            (8, [1.0, 2.0, 3.0], 0), (40, [3.0, 2.0, 1.0], 0), (None, [1.0, 1.0], 0)]
    df = spark.createDataFrame(rows, VECS).withColumns({c: F.lit("x") for c in ("rank", "score", "dim", "shard", "ids")})
    got = {(r.query_id, r.rank): r.vec_id for r in search(df).collect()}
    assert got == {(0, 1): 1, (0, 2): 20, (20, 1): 0, (20, 2): 1, (40, 1): 8}
    assert search(df.where(F.lit(False))).count() == 0
    assert search(df.where("vec_id = 20")).count() == 0
