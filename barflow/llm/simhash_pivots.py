"""SimHash near-duplicates through pivot distance tables.

Fingerprint: words of the lower-cased (A-Z) text, word shingles with repeats,
XXH64 (seed 42) of each; a bit is set if more than half of the hashes set it.

Search: each distinct fingerprint gets its Hamming distances to a table of
reference fingerprints. A pair within ``radius`` bits differs by at most
``radius`` in every coordinate, since distances obey the triangle inequality.
The references come as one random pivot and copies of it with one small block
of bits flipped; the difference of two such distances is the distance within
that block alone, so a pair within the radius differs in at most ``radius``
blocks. Blocks lie in ``groups`` groups; a pair then agrees in every block of at
least ``groups - radius`` groups, and each choice of that many groups makes one
equality key. Pairs that meet are discarded by their largest coordinate
difference over the whole table, and the survivors are verified bit by bit.

Defined results: null and empty texts, and texts of blanks only, have
fingerprint zero and link to each other; repeated rows each get a row; an empty
table gives an empty result; a component whose doc_ids are all null has a null
component_id. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import Scratch, unused
from barflow.llm.links import bit_distance, bucket_links, components, signed

PIVOT = 0x5DEECE66D1CE4E5B     # the random pivot of the table
BLOCK_BITS = 2
CHUNK = 1 << 16                # hashes voted on at once


def majority_bits(text: str | None, shingle: int = 3) -> int:
    """The fingerprint of one text, unsigned."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    grams = (map(b" ".join, zip(*(words[i:] for i in range(shingle))))
             if len(words) >= shingle else [b" ".join(words)])
    hashes = np.fromiter((digest(g, 42) for g in grams), dtype="<u8",
                         count=max(1, len(words) - shingle + 1))
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at:at + CHUNK].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * votes > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """The fingerprint of each text as a signed long."""
    @F.pandas_udf("long")
    def fingerprints(texts: pd.Series) -> pd.Series:
        return pd.Series([signed(majority_bits(t, shingle)) for t in texts], dtype="int64")

    return fingerprints(F.coalesce(text, F.lit("")))


def reference_table(block_bits: int = BLOCK_BITS) -> list[int]:
    """The pivot, then the pivot with each block of bits flipped in turn."""
    block = (1 << block_bits) - 1
    return [signed(PIVOT)] + [signed(PIVOT ^ (block << at)) for at in range(0, 64, block_bits)]


def distance_rows(fps: np.ndarray, table: list[int]) -> np.ndarray:
    """A row for each fingerprint: its Hamming distance to each reference."""
    refs = np.array(table, dtype=np.int64).view(np.uint64)
    return np.bitwise_count(fps.astype(np.int64).view(np.uint64)[:, None] ^ refs[None, :])


def pivot_keys(fps: DataFrame, radius: int, groups: int, block_bits: int = BLOCK_BITS) -> DataFrame:
    """(fp, t, key): one key for each choice of groups whose blocks must agree."""
    if groups <= radius:
        raise ValueError("groups must exceed the radius")
    table = reference_table(block_bits)
    chosen = [[b for b in range(len(table) - 1) if b % groups in c]
              for c in combinations(range(groups), groups - radius)]
    mix = np.random.default_rng(7).integers(1, 1 << 63, size=len(table), dtype=np.uint64) | 1

    @F.pandas_udf("array<long>")
    def keys(values: pd.Series) -> pd.Series:
        d = distance_rows(values.to_numpy(), table).astype(np.int64)
        # half the difference to the pivot's distance: the distance within the block, shifted to 0
        inside = ((d[:, :1] - d[:, 1:] + block_bits) >> 1).astype(np.uint64)
        out = [(inside[:, c] * mix[c]).sum(axis=1, dtype=np.uint64) for c in chosen]
        return pd.Series(list(np.stack(out, axis=1).view(np.int64)))

    return fps.select("fp", F.posexplode(keys("fp")).alias("t", "key"))


def within_coordinates(radius: int, block_bits: int = BLOCK_BITS):
    """The pivot test of a pair: no coordinate differs by more than the radius."""
    table = reference_table(block_bits)

    def test(a: Column, b: Column) -> Column:
        apart = [F.abs(bit_distance(a, F.lit(r)) - bit_distance(b, F.lit(r))) for r in table]
        return F.greatest(*apart) <= radius

    return test


def near_duplicates(docs: DataFrame, radius: int = 2, shingle: int = 3, groups: int = 6,
                    max_bucket: int = 16) -> DataFrame:
    """doc_id, fingerprint, component_id, keep: one row per document.

    ``component_id``: the smallest doc_id reachable over links of at most
    ``radius`` differing bits. ``text_hash`` (XXH64 of the text) tells rows of
    one doc_id apart; ``keep`` marks the row that stands for its component: the
    smallest (doc_id, text_hash), null ids last.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    marked = scratch.cut(docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                                     fingerprint(F.col("text"), shingle).alias("fp")))
    rank = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")
    fps = scratch.cut(marked.groupBy("fp").agg(F.min(rank).alias("first")))
    links = bucket_links(scratch, fps, pivot_keys(fps, radius, groups), radius,
                         within_coordinates(radius), max_bucket)
    roots = scratch.cut(components(scratch, links))
    placed = scratch.cut(fps.join(roots, fps["fp"] == roots["node"], "left")
                         .select("fp", F.coalesce("root", "fp").alias("root"), "first"), roots)
    best = scratch.cut(placed.groupBy("root").agg(F.min("first").alias("best")))
    named = scratch.cut(placed.select("fp", "root").join(best, "root").select("fp", "best"),
                        placed, best)
    out = marked.join(named, "fp")
    return out.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("best.doc_id").alias("component_id"), "text_hash",
        (F.col("doc_id").eqNullSafe(F.col("best.doc_id"))
         & (F.col("text_hash") == F.col("best.text_hash"))).alias("keep"))


def keep_first(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that stand for their component, one for each.

    Of rows that repeat doc_id and text one stays. All columns are kept.
    """
    # the id as text is never null, so one hash partitioning serves join and de-duplication
    def key(c):
        return F.coalesce(c.cast("string"), F.lit("null"))

    k, h = unused(docs, "_key", "_hash")
    kept = (near_duplicates(docs.select("doc_id", "text"), **how).where("keep")
            .select(key(F.col("doc_id")).alias(k), F.col("text_hash").alias(h)).distinct())
    rows = docs.withColumns({k: key(docs["doc_id"]), h: F.xxhash64(docs["text"])})
    return rows.join(kept, [k, h], "left_semi").dropDuplicates([k, h]).drop(k, h)
