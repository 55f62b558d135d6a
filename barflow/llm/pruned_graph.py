"""Nearest neighbours by inner product over robust-pruned directed graphs.

Equal vectors are one node that carries its smallest ids, as many as an answer can
hold. Nodes are dealt into shards by a hash; a task builds each shard's graph:

* vectors get one more coordinate, sqrt(M - |x|^2) with M the largest squared norm
  of the table, so that the nearest node to (q, 0) in Euclidean distance is the one
  with the largest inner product with q;
* starting from a random graph, each node is searched for greedily, and the nodes
  met are pruned to at most ``degree`` neighbours: the nearest stays and removes every
  candidate that lies ``alpha`` times closer to it than to the node, and so on;
  edges are entered in both directions and pruned likewise. A first round prunes
  with 1, a second with ``alpha``, which keeps long edges.

Every block of queries visits every shard; a beam search of ``beam`` nodes answers
each, and the answers of all shards are merged. A shard's graph is built by one
task from at most about ``shard_rows`` vectors, however many there are.

Defined results: vectors that are null, zero, empty or hold a null or non-finite
component take no part; vectors of another length are searched among themselves;
repeated (id, vector) rows count once; ties go to the smaller id; fewer candidates
than ``k`` give fewer rows; an empty table gives an empty result. Columns other than
vec_id and embedding are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barflow.llm.common import Scratch

SHARD_ROWS = 8192
BATCH = 512            # searches that run side by side
EXPAND = 4             # nodes that each search opens in a step


# ------------------------------------------------------------ one shard's graph
def beam_search(x: np.ndarray, graph: np.ndarray, entry: np.ndarray, q: np.ndarray,
                beam: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``q``, the ``beam`` nearest nodes found and their squared distances.

    ``graph`` holds each node's neighbours, filled up with -1. Unused places of an
    answer have node -1 and an infinite distance.
    """
    n, rows = len(x), len(q)
    norm = np.einsum("ij,ij->i", x, x)
    seen = np.zeros((rows, n + 1), dtype=bool)      # the last column stands for -1
    seen[:, n] = True
    ids = np.full((rows, beam), -1, dtype=np.int64)
    dist = np.full((rows, beam), np.inf, dtype=np.float32)
    open_ = np.zeros((rows, beam), dtype=bool)
    first = entry[:beam]
    ids[:, :len(first)] = first
    dist[:, :len(first)] = norm[first] - 2 * q @ x[first].T
    open_[:, :len(first)] = True
    seen[:, first] = True
    active = np.arange(rows)
    while len(active):
        d = np.where(open_[active], dist[active], np.inf)
        pick = np.argpartition(d, min(EXPAND, beam) - 1, axis=1)[:, :EXPAND]
        chosen = np.take_along_axis(d, pick, 1) < np.inf
        busy = chosen.any(axis=1)
        active, pick, chosen = active[busy], pick[busy], chosen[busy]
        if not len(active):
            break
        sub = open_[active]
        np.put_along_axis(sub, pick, np.take_along_axis(sub, pick, 1) & ~chosen, 1)
        open_[active] = sub
        nodes = np.where(chosen, np.take_along_axis(ids[active], pick, 1), -1)
        near = np.where((nodes >= 0)[:, :, None], graph[nodes], -1).reshape(len(active), -1)
        fresh = ~seen[active[:, None], near]
        near = np.where(fresh, near, -1)
        seen[active[:, None], near] = True
        # a node named twice in one step keeps its first place only
        order = np.argsort(near, axis=1, kind="stable")
        ranked = np.take_along_axis(near, order, 1)
        twice = np.zeros_like(ranked, dtype=bool)
        twice[:, 1:] = (ranked[:, 1:] == ranked[:, :-1])
        near = np.where(twice, -1, ranked)
        nd = norm[near] - 2 * np.einsum("ij,ikj->ik", q[active], x[near])
        nd = np.where(near >= 0, nd, np.inf).astype(np.float32)
        all_d = np.concatenate([dist[active], nd], axis=1)
        best = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
        dist[active] = np.take_along_axis(all_d, best, 1)
        ids[active] = np.take_along_axis(np.concatenate([ids[active], near], axis=1), best, 1)
        opened = np.concatenate([open_[active], near >= 0], axis=1)
        open_[active] = np.take_along_axis(opened, best, 1)
    order = np.argsort(dist, axis=1, kind="stable")
    ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
    return np.where(np.isfinite(dist), ids, -1), dist


def robust_prune(x: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int,
                 alpha: float) -> np.ndarray:
    """Diverse neighbours of each node out of its row of candidates (-1: none)."""
    rows = len(nodes)
    own = (candidates < 0) | (candidates == nodes[:, None])
    p, c = x[nodes], x[candidates]
    d = np.where(own, np.inf, ((c - p[:, None, :]) ** 2).sum(axis=2))
    order = np.argsort(d, axis=1, kind="stable")
    d, candidates = np.take_along_axis(d, order, 1), np.take_along_axis(candidates, order, 1)
    c = np.take_along_axis(c, order[:, :, None], 1)
    alive = np.isfinite(d)
    alive[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
    norm = (c * c).sum(axis=2)
    out = np.full((rows, degree), -1, dtype=np.int64)
    line = np.arange(rows)
    for slot in range(degree):
        at = alive.argmax(axis=1)
        has = alive[line, at]
        if not has.any():
            break
        out[has, slot] = candidates[line, at][has]
        star = c[line, at]
        apart = norm + norm[line, at][:, None] - 2 * np.einsum("ij,ikj->ik", star, c)
        alive &= alpha * alpha * apart > d
        alive[line, at] = False
    return out


def build_graph(x: np.ndarray, degree: int, beam: int, alpha: float, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(graph, entry nodes) over the rows of ``x``."""
    n, rng = len(x), np.random.default_rng(seed)
    entry = np.array([int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())])
    graph = np.full((n, degree), -1, dtype=np.int64)
    if n > 1:
        graph[:] = rng.integers(0, n - 1, size=(n, degree))
        graph += graph >= np.arange(n)[:, None]         # anyone but itself
    for relaxed in (1.0, alpha):
        order = rng.permutation(n)
        for begin in range(0, n, BATCH):
            nodes = order[begin:begin + BATCH]
            met, _ = beam_search(x, graph, entry, x[nodes], beam)
            new = robust_prune(x, nodes, np.concatenate([met, graph[nodes]], axis=1), degree, relaxed)
            graph[nodes] = new
            add_reverse(x, graph, nodes, new, degree, relaxed)
    return graph, entry


def add_reverse(x: np.ndarray, graph: np.ndarray, nodes: np.ndarray, new: np.ndarray,
                degree: int, alpha: float) -> None:
    source = np.repeat(nodes, new.shape[1])
    target = new.ravel()
    source, target = source[target >= 0], target[target >= 0]
    known = (graph[target] == source[:, None]).any(axis=1)
    source, target = source[~known], target[~known]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    ends, first, count = np.unique(target, return_index=True, return_counts=True)
    # each target's new neighbours beside those it has, as rows of candidates
    place = np.arange(len(target)) - np.repeat(first, count)
    row = np.repeat(np.arange(len(ends)), count)
    for begin in range(0, len(ends), BATCH):
        part = slice(begin, min(begin + BATCH, len(ends)))
        inside = (row >= part.start) & (row < part.stop)
        offered = np.full((part.stop - part.start, int(count[part].max())), -1, dtype=np.int64)
        offered[row[inside] - part.start, place[inside]] = source[inside]
        have = graph[ends[part]]
        both = np.concatenate([have, offered], axis=1)
        full = (both >= 0).sum(axis=1) > degree
        packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)[:, :degree]
        if full.any():
            packed[full] = robust_prune(x, ends[part][full], both[full], degree, alpha)
        graph[ends[part]] = packed


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    """The vectors with the coordinate that turns inner products into distances."""
    extra = np.sqrt(np.maximum(top - (x.astype(np.float64) ** 2).sum(axis=1), 0.0))
    return np.concatenate([x, extra[:, None]], axis=1).astype(np.float32)


# ------------------------------------------------------------ operator
def usable(vectors: DataFrame) -> DataFrame:
    e = F.col("embedding")
    bad = F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                           e.cast("array<float>").alias("embedding"))
            .where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad
                   & F.exists("embedding", lambda v: v != 0)))


def search(vectors: DataFrame, is_query=None, k: int = 20, degree: int = 32, beam: int = 96,
           alpha: float = 1.2, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest of each query, itself left out."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "pruned-graph")
    if is_query is None:
        is_query = F.col("vec_id") % 20 == 0
    rows = usable(vectors)
    by_id = Window.partitionBy("embedding").orderBy("vec_id")
    nodes = scratch.cut(
        rows.distinct().withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= k + 1)
        .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumn("dim", F.size("embedding"))
        .withColumn("norm", F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v.cast("double") * v)))
    spaces = {r.dim: r for r in nodes.groupBy("dim").agg(F.count(F.lit(1)).alias("n"),
                                                         F.max("norm").alias("top")).collect()}
    shards = {d: math.ceil(r.n / shard_rows) for d, r in spaces.items()}
    tops = {d: r.top for d, r in spaces.items()}
    number = F.create_map(*[F.lit(v) for d, s in shards.items() for v in (d, s)] or [F.lit(0), F.lit(1)])

    def build(key, part: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(part["embedding"].to_numpy()).astype(np.float32)
        order = np.lexsort(x.T[::-1])             # the graph does not depend on the rows' order
        x, ids = x[order], [part["ids"].iloc[i] for i in order]
        graph, entry = build_graph(lifted(x, tops[int(key[0])]), degree, beam, alpha)
        counts = np.array([len(i) for i in ids], dtype=np.int32)
        return pd.DataFrame([{
            "dim": int(key[0]), "shard": int(key[1]), "vectors": x.tobytes(),
            "graph": graph.astype(np.int32).tobytes(), "entry": entry.astype(np.int32).tobytes(),
            "ids": np.concatenate(ids).astype(np.int64).tobytes(), "counts": counts.tobytes()}])

    shard_of = F.pmod(F.xxhash64("embedding"), F.element_at(number, F.col("dim")).cast("long")).cast("int")
    graphs = scratch.cut(
        nodes.select("dim", shard_of.alias("shard"), "embedding", "ids").groupBy("dim", "shard")
        .applyInPandas(build, "dim int, shard int, vectors binary, graph binary, entry binary, "
                              "ids binary, counts binary"), nodes)

    asked = rows.where(is_query).distinct().withColumn("dim", F.size("embedding"))
    n_blocks = max(1, math.ceil(asked.count() / shard_rows))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int")

    def pack(key, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{
            "dim": int(key[0]), "block": int(key[1]),
            "query_ids": part["vec_id"].to_numpy(dtype=np.int64).tobytes(),
            "queries": np.stack(part["embedding"].to_numpy()).astype(np.float32).tobytes()}])

    blocks = scratch.cut(asked.groupBy("dim", block.alias("block")).applyInPandas(
        pack, "dim int, block int, query_ids binary, queries binary"))
    visits = blocks.withColumn("shard", F.explode(F.sequence(
        F.lit(0), F.element_at(number, F.col("dim")) - 1)))

    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                dim = r["dim"]
                x = np.frombuffer(r["vectors"], np.float32).reshape(-1, dim)
                graph = np.frombuffer(r["graph"], np.int32).reshape(len(x), -1).astype(np.int64)
                entry = np.frombuffer(r["entry"], np.int32).astype(np.int64)
                ids = np.frombuffer(r["ids"], np.int64)
                begin = np.r_[0, np.cumsum(np.frombuffer(r["counts"], np.int32))]
                query_ids = np.frombuffer(r["query_ids"], np.int64)
                queries = np.frombuffer(r["queries"], np.float32).reshape(-1, dim)
                high, exact = lifted(x, tops[dim]), x.astype(np.float64)
                for b in range(0, len(queries), BATCH):
                    q = queries[b:b + BATCH]
                    flat = np.concatenate([q, np.zeros((len(q), 1), np.float32)], axis=1)
                    found, _ = beam_search(high, graph, entry, flat, max(beam, k + 1))
                    out = []
                    for qid, vector, hits in zip(query_ids[b:b + BATCH], q.astype(np.float64), found):
                        hits = hits[hits >= 0]
                        scores = (exact[hits] * vector).sum(axis=1)
                        best = np.argsort(-scores, kind="stable")
                        # every vector tied with the last one that counts stays in
                        if len(best) > k + 1:
                            best = best[scores[best] >= scores[best[k]]]
                        who = np.concatenate([ids[begin[h]:begin[h + 1]] for h in hits[best]])
                        how = np.repeat(scores[best], begin[hits[best] + 1] - begin[hits[best]])
                        who, how = who[who != qid], how[who != qid]
                        top = np.lexsort((who, -how))[:k]
                        out.append((np.full(len(top), qid), who[top], how[top]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(c)) for c in zip(*out)], schema=schema)

    # a task's share is one block of queries against one shard. Never by a broadcast: the planner takes
    # the visits to be as small as the blocks' files, but each shard has its own copy of every block
    pairs = visits.hint("merge").join(graphs.hint("merge"), ["dim", "shard"]).repartition("dim", "shard", "block")
    found = pairs.mapInArrow(visit, "query_id long, vec_id long, score double").distinct()
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
