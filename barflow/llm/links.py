"""Links between 64-bit fingerprints and the groups they reach.

``bucket_links`` turns blocking keys into links without ever forming all pairs
of a large bucket; ``components`` finds what the links connect, with joins and
partial aggregations only.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import Scratch

MASK64 = (1 << 64) - 1


def signed(x: int) -> int:
    """An unsigned 64-bit value as the signed long that holds its bits."""
    x &= MASK64
    return x - (1 << 64) if x >> 63 else x


def bit_distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def ball(radius: int) -> list[int]:
    """Masks of at most ``radius`` set bits."""
    return [signed(sum(1 << b for b in bits))
            for r in range(radius + 1) for bits in combinations(range(64), r)]


def dense_links(fps: DataFrame, radius: int) -> DataFrame:
    """Links whose groups are exactly those of all pairs within ``radius`` bits.

    Each fingerprint visits every point at most ``ceil(radius / 2)`` bits away,
    marked ``near`` where it is at most ``floor(radius / 2)`` bits away. Two
    fingerprints within the radius meet at a point where one of them is near,
    and whoever meets a near one is within the radius of it; so linking a
    point's visitors to its smallest near one loses no group. The visitors of a
    point are bounded by the size of the ball, and rows grow in proportion to
    the fingerprints, however densely these lie.
    """
    near = F.array(*[F.lit(m) for m in ball(radius // 2)])
    visits = fps.select("fp", F.explode(F.transform(near, lambda m: F.col("fp").bitwiseXOR(m)))
                        .alias("point"), F.lit(True).alias("near"))
    if radius % 2:
        rim = [m for m in ball(radius // 2 + 1) if bin(m & MASK64).count("1") == radius // 2 + 1]
        far = F.array(*[F.lit(m) for m in rim])
        visits = visits.unionByName(fps.select(
            "fp", F.explode(F.transform(far, lambda m: F.col("fp").bitwiseXOR(m))).alias("point"),
            F.lit(False).alias("near")))
    met = (visits.groupBy("point")
           .agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("b"),
                F.collect_list("fp").alias("all"))
           .where(F.col("b").isNotNull() & (F.size("all") > 1)))
    return (met.select("b", F.explode("all").alias("a")).where("a <> b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))


def bucket_links(scratch: Scratch, fps: DataFrame, keyed: DataFrame, radius: int,
                 survives, max_bucket: int = 16) -> DataFrame:
    """Links (a > b) that connect all fingerprints within ``radius`` bits.

    ``keyed`` holds (fp, t, key): each pair within the radius must share a row
    of (t, key). Buckets of up to ``max_bucket`` fingerprints are joined with
    themselves, ``survives(x, y)`` discards pairs cheaply and the exact bit
    distance verifies the rest. The fingerprints of larger buckets take
    ``dense_links``, whose cost is in proportion to their number; together they
    lose no group.
    """
    sizes = scratch.cut(keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    members = scratch.cut(keyed.join(sizes, ["t", "key"]), sizes)
    small = members.where(F.col("n") <= max_bucket)
    x, y = (small.select("t", "key", F.col("fp").alias(c)) for c in ("a", "b"))
    pairs = (x.join(y, ["t", "key"]).where("a > b").where(survives(F.col("a"), F.col("b")))
             .where(bit_distance(F.col("a"), F.col("b")) <= radius).select("a", "b"))
    crowded = members.where(F.col("n") > max_bucket).select("fp").distinct()
    return scratch.cut(pairs.unionByName(dense_links(crowded, radius)).distinct(), members)


def components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a > b): root is the smallest reachable.

    Alternates two star steps until only stars are left: every node links its larger
    neighbours, then its smaller ones, to the smallest node it knows. A hub is
    never gathered: its minimum is a partial aggregation, and the join back
    reads two written tables, so that a skewed node can be split at run time.
    """
    def settled(e: DataFrame) -> bool:
        """Every node has one link at most, and none links to a node that links on."""
        each = e.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        return (each.where("n > 1").isEmpty()
                and e.select(F.col("b").alias("a")).distinct().join(each, "a", "left_semi").isEmpty())

    e = links
    while not settled(e):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = scratch.cut(both.groupBy("a").agg(F.min("b").alias("m"))
                            .withColumn("m", F.least("a", "m")))
        large = scratch.cut(both.join(least, "a").where("b > a")
                            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(),
                            least, *([e] if e is not links else []))
        least = scratch.cut(large.groupBy("a").agg(F.min("b").alias("m")))
        e = scratch.cut(large.join(least, "a").where("b <> m")
                        .select(F.col("b").alias("a"), F.col("m").alias("b"))
                        .unionByName(least.select("a", F.col("m").alias("b"))).distinct(),
                        least, large)
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
