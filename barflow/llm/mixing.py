"""Mixing sources to target weights by temperature.

A source with share p of all tokens gets weight p**t over the sum of all p**t.
The exponent t is found by repeated section (each step splits the bracket at 15
points, worked out by one aggregation over the sources): either the weights'
entropy meets a target, or no source is repeated more than ``max_epochs`` times.

The weights are realised as a token budget. By default it is the least that lets
every source be read in full at least once, so no document is lost; a given
budget may cut sources short. A source with quota q and s tokens is read q / s
times: whole epochs, then a part of one more. Each source's documents lie in
blocks, dealt by a seeded hash; each epoch visits the blocks in its own order (a
seeded hash of block and epoch) and the documents of a block by a seeded hash.
The last epoch takes blocks in its order until the quota is used; the block that
straddles the end is cut between documents, so a source's tokens exceed its quota
by less than its longest document. Copies of a document are told apart by
``epoch``; ``slot``, from 0 to 1, interleaves the sources evenly when sorted.

At scale: one pass sums tokens by (source, block), pre-aggregated, with at most
``max_blocks`` blocks plus one a source; the documents themselves are not
shuffled, they meet a table with one row a source, broadcast while its files are
small (else joined by a shuffle that splits hot sources).

Defined results: a null source is a source of its own; null and empty texts have
no tokens and are taken once a whole epoch; repeated rows count as often as they
occur; a corpus without tokens takes every row once; an empty table gives an
empty result. Extra columns are kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barflow.llm.common import Scratch, unused
from barflow.operators.joins import bounded_broadcast

SPLITS = 15
ROUNDS = 6


def n_tokens(text: Column) -> Column:
    """Words of a text: runs of anything but white space."""
    words = F.size(F.split(F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")), " "))
    blank = F.coalesce(F.length(F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))), F.lit(0)) == 0
    return F.when(blank, 0).otherwise(words).cast("long")


def source_key(source: Column) -> Column:
    """Never null; a null source differs from every named one."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source.cast("string")))


def section(sources: DataFrame, low: float, high: float, holds) -> float:
    """The largest exponent in [low, high] for which ``holds``, a property that ends once.

    ``holds(t)`` is an aggregate expression over the source table. Each round asks
    for SPLITS exponents at once; after ROUNDS rounds the bracket is 16**-6 wide.
    """
    ends = sources.agg(holds(low).alias("low"), holds(high).alias("high")).first()
    if ends["high"]:
        return high
    if not ends["low"]:
        return low
    for _ in range(ROUNDS):
        grid = [low + (high - low) * i / (SPLITS + 1) for i in range(1, SPLITS + 1)]
        got = sources.agg(*[holds(t).alias(f"t{i}") for i, t in enumerate(grid)]).first()
        good = [t for t, ok in zip(grid, got) if ok]
        bad = [t for t, ok in zip(grid, got) if not ok]
        low, high = max(good, default=low), min(bad, default=high)
    return low


def entropy_reaches(target: float):
    """Entropy (nats) of the weights is at least the target; it falls as t grows from 0."""
    def holds(t: float) -> Column:
        w = F.pow(F.col("share"), F.lit(t))
        # entropy of w / Z is log Z - sum(w log w) / Z
        return F.log(F.sum(w)) - F.sum(w * F.lit(t) * F.log("share")) / F.sum(w) >= F.lit(target)

    return holds


def repeats_stay_below(max_epochs: float):
    """Reading every source once at least repeats none more than ``max_epochs`` times.

    A source's epochs are in proportion to share ** (t - 1); holds for 1 - t small
    enough, so the search runs over u = 1 - t.
    """
    def holds(u: float) -> Column:
        epochs = F.pow(F.col("share"), F.lit(-u))
        return F.max(epochs) / F.min(epochs) <= F.lit(max_epochs)

    return holds


def plan_sources(docs_tokens: DataFrame, scratch: Scratch, max_epochs: float | None,
                 entropy: float | None, budget: int | None) -> tuple[DataFrame, float]:
    """One row a source: tokens, weight, quota, epochs; and the exponent."""
    sums = scratch.cut(docs_tokens.groupBy("source_key").agg(F.sum("tokens").alias("source_tokens")))
    every = sums.agg(F.sum("source_tokens")).first()[0] or 0
    some = sums.where("source_tokens > 0").withColumn("share", F.col("source_tokens") / F.lit(float(every or 1)))
    if not every:
        t = 1.0
    elif entropy is not None:
        most = math.log(max(1, some.count()))
        t = section(some, 0.0, 8.0, entropy_reaches(entropy * most))
    else:
        t = 1.0 - section(some, 0.0, 1.0, repeats_stay_below(max_epochs))
    raised = some.withColumn("raised", F.pow("share", F.lit(t)))
    total = raised.agg(F.sum("raised").alias("z"), F.max(F.col("source_tokens") / F.col("raised")).alias("least")).first()
    whole = budget if budget is not None else (total["least"] or 0.0) * (total["z"] or 0.0)
    planned = raised.select(
        "source_key", "source_tokens", (F.col("raised") / F.lit(total["z"] or 1.0)).alias("weight"))
    # a source's epochs, rounded where floating point only just misses a whole number
    epochs = F.round(F.col("weight") * F.lit(float(whole)) / F.col("source_tokens"), 9)
    idle = sums.where("source_tokens = 0 or source_tokens is null").select(
        "source_key", F.lit(0).cast("long").alias("source_tokens"), F.lit(0.0).alias("weight"),
        F.lit(1.0).alias("epochs"))
    return scratch.cut(planned.withColumn("epochs", epochs).unionByName(idle), sums), t


def seeded(seed: int, *cols: Column) -> Column:
    return F.xxhash64(F.lit(seed), *cols)


def realise(docs: DataFrame, max_epochs: float | None = 2.0, entropy: float | None = None,
            budget: int | None = None, block_tokens: int = 1_000_000, max_blocks: int = 100_000,
            seed: int = 17) -> DataFrame:
    """``docs`` as often as the mixture takes each row, with the columns of its plan.

    Adds tokens, weight, epoch (from 0), block and slot. ``entropy`` (a share of
    the largest possible) or ``max_epochs`` steers the exponent; ``budget`` in
    tokens replaces the least one that reads every source in full.
    """
    if (max_epochs is None) == (entropy is None):
        raise ValueError("give max_epochs or entropy")
    scratch = Scratch(docs.sparkSession, "mixing")
    key, block, at, whole, part, last, cut, doc_at = unused(
        docs, "_source", "_block", "_at", "_whole", "_part", "_last", "_cut", "_doc_at")
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    tokens = n_tokens(F.col("text"))
    light = scratch.cut(docs.select(
        source_key(F.col("source")).alias("source_key"), ident.alias("ident"),
        F.xxhash64("text").alias("text_hash"), tokens.alias("tokens")))
    sources, t = plan_sources(light, scratch, max_epochs, entropy, budget)
    every = light.agg(F.sum("tokens")).first()[0] or 0
    size = max(block_tokens, math.ceil(every / max_blocks))
    sources = scratch.cut(sources.withColumn(
        "blocks", F.greatest(F.lit(1), F.ceil(F.col("source_tokens") / F.lit(size)))), sources)

    def block_of(ident: Column, text_hash: Column) -> Column:
        return F.pmod(seeded(seed, ident, text_hash), F.col("blocks"))

    def order_of(block: Column, epoch: Column) -> Column:
        return seeded(seed + 1, F.col("source_key"), block, epoch)

    def inner_of(ident: Column, text_hash: Column, epoch: Column) -> Column:
        return seeded(seed + 2, ident, text_hash, epoch)

    # the last, partial epoch: blocks in its order until the rest of the quota is used
    cut_short = sources.withColumn("full", F.floor("epochs").cast("int")).withColumn(
        "rest", (F.col("epochs") - F.col("full")) * F.col("source_tokens"))
    sums = (light.join(bounded_broadcast(cut_short.where("rest > 0")), "source_key")
            .withColumn("block", block_of(F.col("ident"), F.col("text_hash")))
            .groupBy("source_key", "block", "full", "rest").agg(F.sum("tokens").alias("tokens")))
    by_order = Window.partitionBy("source_key").orderBy("at", "block")
    running = (sums.withColumn("at", order_of(F.col("block"), F.col("full")))
               .withColumn("before", F.sum("tokens").over(by_order) - F.col("tokens")))
    edge = scratch.cut(running.where((F.col("before") < F.col("rest"))
                                     & (F.col("before") + F.col("tokens") >= F.col("rest")))
                       .select("source_key", F.col("block").alias("edge"), F.col("at").alias("edge_at"),
                               (F.col("rest") - F.col("before")).alias("edge_rest")))
    # inside the straddling block: documents by their hash, until its share is used
    inside = (light.join(bounded_broadcast(cut_short.join(edge, "source_key")), "source_key")
              .where(block_of(F.col("ident"), F.col("text_hash")) == F.col("edge"))
              .withColumn("doc_at", inner_of(F.col("ident"), F.col("text_hash"), F.col("full")))
              .groupBy("source_key", "doc_at", "edge_rest").agg(F.sum("tokens").alias("tokens")))
    walk = Window.partitionBy("source_key").orderBy("doc_at")
    stop = (inside.withColumn("before", F.sum("tokens").over(walk) - F.col("tokens"))
            .where(F.col("before") < F.col("edge_rest"))
            .groupBy("source_key").agg(F.max("doc_at").alias("doc_stop")))
    plan = scratch.cut(cut_short.join(edge, "source_key", "left").join(stop, "source_key", "left"),
                       edge, light)

    rows = docs.withColumns({key: source_key(F.col("source")), at: ident})
    rows = rows.join(bounded_broadcast(plan.select(F.col("source_key").alias(key), F.struct(
        "source_key", "weight", "epochs", "full", "blocks", "edge", "edge_at", "doc_stop").alias(whole))), key)
    p = F.col(whole)
    text_hash = F.xxhash64("text")
    rows = rows.withColumn(block, F.pmod(seeded(seed, F.col(at), text_hash), p["blocks"]))
    order_last = seeded(seed + 1, p["source_key"], F.col(block), p["full"])
    inner_last = seeded(seed + 2, F.col(at), text_hash, p["full"])
    in_last = (p["edge"].isNotNull() & (
        (order_last < p["edge_at"])
        | ((order_last == p["edge_at"]) & (F.col(block) < p["edge"]))
        | ((F.col(block) == p["edge"]) & (inner_last <= p["doc_stop"]))))
    times = p["full"] + F.when(in_last, 1).otherwise(0)
    rows = rows.withColumn(part, F.explode(F.when(times > 0, F.sequence(F.lit(0), times - 1))
                                           .otherwise(F.array().cast("array<int>"))))
    place = seeded(seed + 1, p["source_key"], F.col(block), F.col(part))
    # a hash of the block's order, then of the document's, as a fraction of an epoch
    unit = F.pmod(place, F.lit(1 << 30)) / F.lit(float(1 << 30))
    fine = F.pmod(seeded(seed + 2, F.col(at), text_hash, F.col(part)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    span = F.greatest(p["epochs"], F.lit(1e-9))
    slot = (F.col(part) + F.when(F.col(part) < p["full"], F.lit(1.0)).otherwise(p["epochs"] - p["full"])
            * (unit + fine / p["blocks"] / 2) / 1.5) / span
    added = {"tokens": tokens, "weight": p["weight"], "epoch": F.col(part), "block": F.col(block),
             "slot": F.least(slot, F.lit(1.0))}
    return rows.select(*docs.columns, *[c.alias(n) for n, c in zip(unused(docs, *added), added.values())])


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The rows of the mixture with the columns of ``docs`` only."""
    return realise(docs, **how).select(*docs.columns)
