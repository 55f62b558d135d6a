"""MinHash near-duplicates: one-permutation hashing, banded buckets, star-shaped candidates.

A document's set holds its distinct word shingles (lower-cased A-Z; words split at ASCII
blanks; with fewer words than a shingle the whole sequence is its one shingle). Documents
with 100 * intersection >= ``percent`` * union are linked; links are confirmed on full sets.

* Documents with equal sets form a class, found by a 128-bit digest of the set.
* Sketch: one permutation throws every shingle into one of ``BINS`` bins, which keeps its
  least hash. An empty bin takes the value of the bin that its own sequence of probes, the
  same for all documents, first finds filled (optimal densification). ``BANDS`` bands of
  ``ROWS`` bins give bucket keys: two sets 0.85 alike miss each other in all bands with
  probability 7e-11.
* Stars: a bucket proposes edges from its hub alone (the class with most documents), so a
  bucket of n classes has n - 1 candidates. Confirmed edges connect classes.
* The rest: a star leaves open how the hub's partners and the others relate. Buckets whose
  members are still in several groups send their members into an exact prefix join: in any
  fixed order of shingles, sets that alike share one of the first
  n - ceil(percent n / 100) + 1 shingles of each, and where the first they share stands at
  places i and j (from 0), no more than min(n - i, m - j) are shared in all. Shingles of
  the most crowded hubs come last in the order: what a large group shares stands so late
  in a text apart from the hub that it proposes nobody; pairs within a group already
  connected are left out.

Candidates are discarded by two exact bounds before full sets are fetched: of their sizes,
and of a parity map (``PARITY`` bits, each the parity of the shingles that fall on it), as
two maps differ in no more bits than the sets in shingles. Neither loses a link.

Everything grows with the documents in written tables; the driver sees counts and the
bounded list of slots of the crowded hubs' shingles.

Defined results: null, empty and blank texts have the empty set and stand alone; repeated
rows are copies; a null doc_id never names a group that has another, and a group of null
ids only has a null component_id; an empty table gives an empty result. Columns other than
doc_id and text are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import Scratch
from barflow.llm.links import components
from barflow.operators.joins import bounded_broadcast

BANDS, ROWS = 40, 5
BINS = BANDS * ROWS
PARITY = 1024
FOLDED = 256             # bits of the map that goes with a shingle
PROBES = 512
CROWDED_HUBS = 512       # hubs whose shingles come last in the prefix order
SLOTS = 1 << 21          # of shingles, for telling which these are
BROADCAST_BYTES = 64 << 20

_draw = np.random.default_rng(11)
# where an empty bin looks for a value, attempt by attempt
PROBE = _draw.integers(0, BINS, size=(PROBES, BINS), dtype=np.int64)
MIX = _draw.integers(1, 1 << 63, size=(BANDS, ROWS + 1), dtype=np.uint64) | np.uint64(1)


def shingles(text: str | None, k: int = 5) -> np.ndarray:
    """XXH64 hashes of the distinct shingles, sorted."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    grams = set(map(b" ".join, zip(*(words[i:] for i in range(k)))) if len(words) >= k else [b" ".join(words)])
    return np.sort(np.fromiter(map(xxhash.xxh64_intdigest, grams), dtype=np.uint64, count=len(grams)))


def one_permutation(hashes: np.ndarray) -> np.ndarray:
    """The least hash of each bin; empty bins take the first filled bin their probes find."""
    bins = ((hashes >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    starts = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])      # hashes are sorted, so bins are
    values = np.zeros(BINS, dtype=np.uint64)
    filled = np.zeros(BINS, dtype=bool)
    values[bins[starts]] = np.minimum.reduceat(hashes & np.uint64(0xFFFFFFFF), starts)
    filled[bins[starts]] = True
    empty = np.flatnonzero(~filled)
    if len(empty):
        finds = filled[PROBE[:, empty]]
        attempt = finds.argmax(axis=0)
        source = PROBE[attempt, empty]
        # after PROBES attempts without a find: the next filled bin in turn
        lost = ~finds[attempt, np.arange(len(empty))]
        if lost.any():
            where = np.flatnonzero(filled)
            source[lost] = where[np.searchsorted(where, empty[lost]) % len(where)]
        values[empty] = values[source]
    return values


def bucket_keys(hashes: np.ndarray) -> np.ndarray:
    """One key for each band; the band is part of it."""
    rows = one_permutation(hashes).reshape(BANDS, ROWS)
    x = (rows * MIX[:, :ROWS]).sum(axis=1, dtype=np.uint64) + MIX[:, ROWS]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))).view(np.int64)


def parity_map(hashes: np.ndarray) -> np.ndarray:
    """PARITY bits as longs: each tells whether an odd number of hashes falls on it."""
    odd = np.bincount((hashes & np.uint64(PARITY - 1)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def folded(parity: Column, longs: int) -> Column:
    """The parity map of fewer bits: bits that fall together are added up."""
    def column(i: int) -> Column:
        parts = [F.get(parity, F.lit(j)) for j in range(i, PARITY // 64, longs)]
        return reduce(lambda x, y: x.bitwiseXOR(y), parts)

    return F.array(*map(column, range(longs)))


def differing(a: str, b: str, longs: int) -> Column:
    """In how many bits two parity maps differ."""
    return reduce(lambda x, y: x + y, (F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i))))
                                       for i in range(longs)))


def sketch(text: Column, k: int) -> Column:
    """struct<n, set, keys, parity>: of an empty set only n is there."""
    @F.pandas_udf("n long, set binary, keys array<long>, parity array<long>")
    def sketches(texts: pd.Series) -> pd.DataFrame:
        import xxhash

        out = []
        for t in texts:
            h = shingles(t, k)
            out.append((len(h), xxhash.xxh3_128_digest(h.tobytes()), bucket_keys(h), parity_map(h))
                       if len(h) else (0, None, None, None))
        return pd.DataFrame(out, columns=["n", "set", "keys", "parity"])

    return sketches(text)


def full_sets(text: Column, k: int) -> Column:
    @F.pandas_udf("array<long>")
    def sets(texts: pd.Series) -> pd.Series:
        return pd.Series([shingles(t, k).view(np.int64) for t in texts])

    return sets(text)


def first_shingles(shingle_set: Column, crowded: np.ndarray, percent: int) -> Column:
    """The shingles of a set that any set alike must share one of."""
    bits = np.zeros(SLOTS, dtype=bool)
    bits[crowded] = True
    bits = np.packbits(bits)

    @F.pandas_udf("array<long>")
    def first(sets: pd.Series) -> pd.Series:
        last = np.unpackbits(bits).astype(bool)
        out = []
        for s in sets:
            s = np.asarray(s, dtype=np.int64)
            order = np.lexsort((s, last[s & (SLOTS - 1)]))
            out.append(s[order[:len(s) + (-percent * len(s) // 100) + 1]])
        return pd.Series(out)

    return first(shingle_set)


class NearDuplicates:
    """The steps over one frame of documents (doc_id, text)."""

    def __init__(self, docs: DataFrame, percent: int = 85, shingle: int = 5):
        self.docs, self.percent, self.shingle = docs.select("doc_id", "text"), percent, shingle
        self.scratch = Scratch(docs.sparkSession, "minhash")
        self.marked = self.scratch.cut(
            self.docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                             sketch(F.col("text"), shingle).alias("s"))
            .select("doc_id", "text_hash", "s.*"))
        known = self.marked.where("n > 0")
        # a class takes its sketch from one of its documents: equal sets have equal ones
        self.classes = self.scratch.cut(
            known.groupBy("set").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least"),
                                     F.min(F.struct("text_hash", "doc_id", "n", "keys", "parity")).alias("one"))
            .select(F.monotonically_increasing_id().alias("node"), "set", "copies", "least", "one.*"))

    def bucket_members(self) -> DataFrame:
        """(key, node, copies) of buckets with more than one class."""
        keyed = self.classes.select(F.explode("keys").alias("key"), "node", "copies")
        shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("key")
        return self.scratch.cut(keyed.join(shared, "key"))

    def stars(self, members: DataFrame) -> DataFrame:
        """(a, b), a > b: each member of a bucket with the bucket's hub."""
        hubs = members.groupBy("key").agg(F.max(F.struct("copies", -F.col("node"))).alias("hub"))
        hubs = hubs.select("key", (-F.col("hub.col2")).alias("hub"))
        return (members.join(hubs, "key").where("node <> hub")
                .select(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b")).distinct())

    def sets_of(self, members: DataFrame) -> DataFrame:
        """(node, n, set): full sets of the classes in buckets, each made of one document again."""
        wanted = (self.classes.join(members.select("node").distinct(), "node", "left_semi")
                  .select("node", "text_hash", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id")))
        texts = self.docs.select(F.xxhash64("text").alias("text_hash"), "text",
                                 F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"))
        found = (texts.join(bounded_broadcast(wanted, BROADCAST_BYTES), ["text_hash", "id"])
                 .select("node", full_sets(F.col("text"), self.shingle).alias("set")))
        return self.scratch.cut(found)

    def possible(self, pairs: DataFrame) -> DataFrame:
        """Pairs that the sizes and parity maps do not rule out."""
        side = self.classes.select("node", "n", "parity")
        a, b = (side.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("parity").alias(f"p_{c}"))
                for c in ("a", "b"))
        differ = differing("p_a", "p_b", PARITY // 64)
        both = F.col("n_a") + F.col("n_b")
        return (pairs.join(a, "a").join(b, "b")
                .where(100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b"))
                # i >= p (both - i) / 100 shared leave (100 - p) both / (100 + p) at most that differ
                .where((100 + self.percent) * differ <= (100 - self.percent) * both)
                .select("a", "b", "n_a", "n_b"))

    def confirmed(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The links among ``pairs``, on full sets."""
        pairs = self.scratch.cut(self.possible(pairs))
        a, b = (sets.select(F.col("node").alias(c), F.col("set").alias(f"set_{c}")) for c in ("a", "b"))
        shared = F.size(F.array_intersect("set_a", "set_b"))
        return self.scratch.cut(
            pairs.join(a, "a").join(b, "b").withColumn("shared", shared)
            .where(100 * F.col("shared") >= self.percent * (F.col("n_a") + F.col("n_b") - F.col("shared")))
            .select("a", "b").distinct(), pairs)

    def rest(self, members: DataFrame, groups: DataFrame, sets: DataFrame) -> DataFrame:
        """Pairs of classes not yet connected that share a first shingle, from buckets not yet one group."""
        placed = members.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
        placed = self.scratch.cut(placed.select("key", "node", "copies", "root"))
        mixed = self.scratch.cut(
            placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"),
                                      F.count(F.lit(1)).alias("m"),
                                      F.max(F.struct("copies", -F.col("node"))).alias("hub"))
            .where("low <> high").select("key", "m", (-F.col("hub.col2")).alias("hub")))
        open_nodes = placed.join(mixed.select("key"), "key", "left_semi").select("node", "root").distinct()
        crowded = mixed.groupBy("hub").agg(F.max("m").alias("m")).orderBy(F.desc("m"), "hub").limit(CROWDED_HUBS)
        slots = (sets.join(F.broadcast(crowded.select(F.col("hub").alias("node"))), "node", "left_semi")
                 .select(F.explode("set").alias("x")).select(F.col("x").bitwiseAND(F.lit(SLOTS - 1)).alias("slot"))
                 .distinct().toPandas()["slot"].to_numpy())        # at most SLOTS
        sized = self.classes.select("node", "n", folded(F.col("parity"), FOLDED // 64).alias("parity"))
        first = self.scratch.cut(
            sets.join(open_nodes, "node").join(sized, "node")
            .select("node", "root", "n", "parity",
                    F.posexplode(first_shingles(F.col("set"), slots, self.percent)).alias("at", "x")),
            placed, mixed)
        shared = first.groupBy("x").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
        first = self.scratch.cut(first.join(shared.select("x"), "x"), first)
        a, b = (first.select("x", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "root", "n", "parity", "at")])
                for s in ("a", "b"))
        most = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
        both = F.col("n_a") + F.col("n_b")
        pairs = (a.join(b, "x").where("node_a > node_b and root_a <> root_b")
                 .where((100 + self.percent) * most >= self.percent * both)
                 .where((100 + self.percent) * differing("parity_a", "parity_b", FOLDED // 64)
                        <= (100 - self.percent) * both)
                 .select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct())
        return self.scratch.cut(pairs, first)

    def groups(self) -> DataFrame:
        """(node, root) of classes linked with others."""
        members = self.bucket_members()
        sets = self.sets_of(members)
        links = self.confirmed(self.stars(members), sets)
        groups = self.scratch.cut(components(self.scratch, links))
        more = self.confirmed(self.rest(members, groups, sets), sets)
        self.scratch.drop(members, sets)
        if more.isEmpty():
            return groups
        return self.scratch.cut(components(self.scratch, self.scratch.cut(links.unionByName(more), links, more)))

    def result(self) -> DataFrame:
        """doc_id, n_shingles, component_id, kept: one row for each document."""
        placed = (self.classes.select("node", "set", "least").join(self.groups(), "node", "left")
                  .withColumn("root", F.coalesce("root", "node")))
        placed = self.scratch.cut(placed)
        best = placed.groupBy("root").agg(F.min("least").alias("component_id"))
        named = placed.join(best, "root").select("set", "component_id")
        out = self.marked.select("doc_id", "n", "set").join(named, "set", "left")
        component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
        return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                          F.col("doc_id").eqNullSafe(component).alias("kept"))


def near_duplicates(docs: DataFrame, percent: int = 85, shingle: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable), kept."""
    return NearDuplicates(docs, percent, shingle).result()
