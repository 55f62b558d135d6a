"""Toxicity through class-conditional Kneser-Ney models whose counts stay in tables.

Every labelled training document is counted, each class by itself, and every pair
stays: counts are written as Parquet under 64-bit hashes and grow with the corpus.
For each class c (toxic, ordinary):

    P_c(w | h) = max(n_c(h,w) - E, 0) / n_c(h)  +  left(h) * P_c(w)
    P_c(w)     = max(k_c(w) - D, 0) / k_c       +  left * P(w)
    P(w)       = (k(w) + 1) / (k + words + 1)

``n_c(h,w)`` counts the documents of class c with the pair, ``n_c(h)`` sums them over
w; a pair repeated in one document counts once. ``k_c(w)`` counts the distinct words
before w in class c, ``k(w)`` in both together. Counts are shared in P(w) alone. What
a class's discounts leave is sum(min(n_c(h,w), E)) / n_c(h), which for E < 1 is
E t_c(h) / n_c(h) with its t_c distinct followers, and 1 where c never saw h;
``left(h)`` and ``left`` are the larger of the two classes' shares, so that what is
unseen in both cancels out instead of speaking for the smaller class.

A text has four features. The plain comparison: the mean over its words of
log P_toxic(w | h) - log P_ordinary(w | h), that is the difference of the two
length-normalised log-likelihoods. The same of its most toxic places: the text is cut
into windows of WINDOW words, and the mean is taken over the tenth of the windows (one at
least) that lean most to toxic, once of P_c(w | h) and once of P_c(w). And the log of its
length. A logistic curve over them, fitted on labelled documents left out of the counts,
gives the score; D is the value of a fixed list under which it is likeliest, E is fixed.

Scoring needs little of the counts once D is known. Where neither class has a
pair more than E times, both classes leave the same share to the word, and the ratio is
the word's own; where neither has a word in more than D contexts, its ratio is 1. So one
table holds the log ratio of every other pair and word: nothing is left out of the
result. Up to ``TABLE_ROWS`` rows (counted) it goes to the tasks, and texts stay where they
are. Beyond, texts and table meet by a join: texts are written once in chunks of CHUNK
bytes, each chunk asks once for each of its distinct words and pairs that pass a Bloom
filter of the table's keys (a miss has no row), and the answers meet the chunk's rows.

Defined results: null, empty and blank texts have no evidence and length 0, and score
like any text; repeated rows score alike and count as often as they occur; unlabelled
rows, null labels and null ids train nothing; without both classes in the training rows
every score is 0.0. Columns other than text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from barflow.llm.common import Scratch, fold, unused
from barflow.operators.joins import bounded_broadcast

DISCOUNTS = (1.0, 2.0, 4.0, 8.0, 16.0, 64.0)
PAIR_DISCOUNTS = (8.0,)   # likeliest of 0.75, 2, 4, 8, 16, 64 on the curve's documents of sf0.1
WINDOW = 4
TRIM = b".,;:!?\"'()[]{}*%$&#"
BROADCAST_BYTES = 64 << 20
FLUSH = 1_000_000        # pairs that a counting task holds before it passes them on
TABLE_ROWS = 4_000_000   # of 16 bytes: what a task may be sent of the scoring table
PART_ROWS = 500_000      # of the scoring table, collected at once
CHUNK = 2 << 20
TEXTS = 256              # whose words are looked up at once
ROW = 64                 # bytes that a row counts besides its text
START = 0                # the context of a text's first word
CLASSES = ("toxic", "plain")
KINDS = ("k_toxic", "k_plain", "k")
BLOOM_BITS = 1 << 26
BLOOM_BLOCK = 1 << 16    # bits that one row of the filter holds


def taken(c: str, e: float) -> str:
    """The column of sum(min(n_c(h,w), e)) over w."""
    return f"{c}_{PAIR_DISCOUNTS.index(e)}"


class WordKeys:
    """Words of texts as 64-bit hashes; the cache of known words stays bounded."""

    def __init__(self, most: int = 500_000):
        self.known: dict[bytes, int] = {}
        self.most = most

    def __call__(self, text: str | None) -> np.ndarray:
        import xxhash

        words = (text or "").lower().encode("utf-8", "surrogatepass").split()
        known = self.known
        try:
            return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words)).view(np.int64)
        except KeyError:
            if len(known) > self.most:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh64_intdigest(w.strip(TRIM) or w)
            return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words)).view(np.int64)


def contexts(w: np.ndarray) -> np.ndarray:
    return np.r_[np.int64(START), w[:-1]]


def pair_hash(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    x = h.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + w.view(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))).view(np.int64)


def pair_key(h: str, w: str) -> Column:
    @F.pandas_udf("long")
    def keys(hs: pd.Series, ws: pd.Series) -> pd.Series:
        return pd.Series(pair_hash(hs.to_numpy(np.int64), ws.to_numpy(np.int64)))

    return keys(h, w)


def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(h, w, toxic, plain) counts of one task's labelled texts, held in bounded parts."""
    ids = WordKeys()
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def flush() -> pd.DataFrame:
        h, w, c = (np.concatenate(x) for x in zip(*held))
        held.clear()
        pair, first, where = np.unique(pair_hash(h, w), return_index=True, return_inverse=True)
        toxic = np.bincount(where, c, len(pair)).astype(np.int64)
        return pd.DataFrame({"h": h[first], "w": w[first], "toxic": toxic,
                             "plain": np.bincount(where, minlength=len(pair)) - toxic})

    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"]):
            w = ids(text)
            if len(w):
                h = contexts(w)
                once = np.unique(pair_hash(h, w), return_index=True)[1]
                h, w = h[once], w[once]
                held.append((h, w, np.full(len(w), toxic, dtype=np.int8)))
                size += len(w)
            if size > FLUSH:
                yield flush()
                size = 0
    if held:
        yield flush()


@dataclass
class Model:
    """The count tables, their sums, and the curve for one pair of discounts."""

    pairs: DataFrame | None   # h, w, toxic, plain
    words: DataFrame | None   # key; as context: CLASSES and ``taken`` of them; as word: KINDS
    k: dict[str, int]         # sums of contexts: toxic, plain, both
    vocabulary: int
    left: dict[float, float]  # by discount
    discounts: tuple[float, ...] = DISCOUNTS
    pair_discounts: tuple[float, ...] = PAIR_DISCOUNTS
    curve: tuple[float, ...] | None = None       # of the features in their order, then 1
    table: DataFrame | None = None               # key, ratio: for scoring
    rows: int = 0                                # of the table

    def columns(self) -> list[str]:
        return [*CLASSES, *[taken(c, e) for c in CLASSES for e in self.pair_discounts], *KINDS]

    def known(self) -> DataFrame:
        """What is known of a key, a pair's or a word's. Pairs that every discount takes whole have no effect."""
        columns = self.columns()
        pairs = self.pairs.where(F.greatest(*CLASSES) > min(self.pair_discounts))
        none = [F.lit(0).cast(self.words.schema[c].dataType).alias(c) for c in columns[2:]]
        return (pairs.select(pair_key("h", "w").alias("key"), *CLASSES, *none)
                .unionByName(self.words.select("key", *columns)))

    def low(self, c: str, d: float) -> Column:
        """P_c(w) from a word's counts."""
        shared = (F.col("k") + 1) / F.lit(float(self.k["both"] + self.vocabulary + 1))
        return F.greatest(F.col(f"k_{c}") - d, F.lit(0.0)) / float(self.k[c]) + self.left[d] * shared

    def ratios(self, d: float, e: float) -> DataFrame:
        """(key, ratio): the log ratio of every word, and of every pair where it is not the word's own."""
        words = self.words.where(F.greatest("k_toxic", "k_plain") > d)
        of_words = words.select("key", F.log(self.low("toxic", d) / self.low("plain", d)).alias("ratio"))
        follower = self.words.select(F.col("key").alias("w"), *[self.low(c, d).alias(f"low_{c}") for c in CLASSES])
        left = F.greatest(*[F.when(F.col(c) > 0, F.col(taken(c, e)) / F.col(c)).otherwise(1.0) for c in CLASSES])
        context = self.words.select(F.col("key").alias("h"), left.alias("left"),
                                    *[F.greatest(F.col(c), F.lit(1)).alias(f"all_{c}") for c in CLASSES])
        toxic, plain = (F.greatest(F.col(c) - e, F.lit(0.0)) / F.col(f"all_{c}")
                        + F.col("left") * F.col(f"low_{c}") for c in CLASSES)
        of_pairs = (self.pairs.where(F.greatest(*CLASSES) > e).join(follower, "w").join(context, "h")
                    .select(pair_key("h", "w").alias("key"), F.log(toxic / plain).alias("ratio")))
        return of_words.unionByName(of_pairs)


def count(rows: DataFrame, scratch: Scratch) -> Model | None:
    """The tables of labelled ``rows`` (text, toxic); None without both classes."""
    pairs = scratch.cut(rows.mapInPandas(counted, "h long, w long, toxic long, plain long")
                        .groupBy("h", "w").agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain")))
    zero = F.lit(0).cast("long")
    parts = {taken(c, e): F.least(F.col(c), F.lit(e)) for c in CLASSES for e in PAIR_DISCOUNTS}
    seen = {"k_toxic": (F.col("toxic") > 0).cast("long"), "k_plain": (F.col("plain") > 0).cast("long"),
            "k": F.lit(1).cast("long")}
    as_context = {"toxic": F.col("toxic"), "plain": F.col("plain"), **parts, **dict.fromkeys(seen, zero)}
    as_word = {**dict.fromkeys(CLASSES, zero), **dict.fromkeys(parts, F.lit(0.0)), **seen}
    words = scratch.cut(
        pairs.select(F.col("h").alias("key"), *[e.alias(c) for c, e in as_context.items()])
        .unionAll(pairs.select(F.col("w").alias("key"), *[e.alias(c) for c, e in as_word.items()]))
        .groupBy("key").agg(*[F.sum(c).alias(c) for c in as_word]))
    sums = words.agg(
        *[F.sum(f"k_{c}").alias(c) for c in CLASSES], F.sum("k").alias("both"),
        F.count_if(F.col("k") > 0).alias("words"),
        *[F.sum(F.least(F.col(f"k_{c}"), F.lit(d))).alias(f"{c}{i}")
          for c in CLASSES for i, d in enumerate(DISCOUNTS)]).first()
    if not sums["toxic"] or not sums["plain"]:
        scratch.drop(pairs, words)
        return None
    left = {d: max(sums[f"{c}{i}"] / sums[c] for c in CLASSES) for i, d in enumerate(DISCOUNTS)}
    return Model(pairs, words, {c: sums[c] for c in (*CLASSES, "both")}, sums["words"], left)


def lookup(key: np.ndarray, ask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each asked key stands in the sorted ``key``, and whether it does."""
    if not len(key):
        return np.zeros(len(ask), dtype=np.int64), np.zeros(len(ask), dtype=bool)
    at = np.minimum(np.searchsorted(key, ask), len(key) - 1)
    return at, key[at] == ask


def counted_ratios(h: np.ndarray, w: np.ndarray, known: dict[str, np.ndarray], model: Model) -> list[np.ndarray]:
    """Log-likelihood ratios from counts: of words for each discount, then of pairs for each two."""
    def found(ask: np.ndarray, columns: list[str]) -> dict[str, np.ndarray]:
        at, hit = lookup(known["key"], ask)
        return {c: np.where(hit, known[c][at], 0) if len(known["key"]) else np.zeros(len(ask)) for c in columns}

    word, pair = found(w, KINDS), found(pair_hash(h, w), CLASSES)
    context = found(h, [c for c in model.columns() if c not in KINDS])
    shared = (word["k"] + 1) / (model.k["both"] + model.vocabulary + 1)
    low = {(c, d): np.maximum(word[f"k_{c}"] - d, 0) / model.k[c] + model.left[d] * shared
           for d in model.discounts for c in CLASSES}
    out = [np.log(low["toxic", d] / low["plain", d]) for d in model.discounts]
    total = {c: np.maximum(context[c], 1) for c in CLASSES}
    for e in model.pair_discounts:
        left = np.maximum(*[np.where(context[c] > 0, context[taken(c, e)] / total[c], 1.0) for c in CLASSES])
        toxic, plain = (np.maximum(pair[c] - e, 0) / total[c] for c in CLASSES)
        out += [np.log((toxic + left * low["toxic", d]) / (plain + left * low["plain", d]))
                for d in model.discounts]
    return out


def tabled_ratios(h: np.ndarray, w: np.ndarray, known: dict[str, np.ndarray]) -> list[np.ndarray]:
    """The same for one D and E, from the scoring table."""
    def found(ask: np.ndarray, otherwise: np.ndarray | float) -> np.ndarray:
        at, hit = lookup(known["key"], ask)
        return np.where(hit, known["ratio"][at], otherwise) if len(known["key"]) else np.zeros(len(ask)) + otherwise

    word = found(w, 0.0)
    return [word, found(pair_hash(h, w), word)]


def evidence(ratio: np.ndarray) -> float:
    """Of the places of one text that lean most to toxic."""
    if not len(ratio):
        return 0.0
    starts = np.arange(0, len(ratio), WINDOW)
    windows = np.add.reduceat(ratio, starts) / np.minimum(WINDOW, len(ratio) - starts)
    most = max(1, round(len(starts) / 10))
    return float(np.partition(windows, len(starts) - most)[len(starts) - most:].mean())


def of_texts(texts: list[str | None], ids: WordKeys, ratios: Callable) -> list[list[float]]:
    """For each text and each of ``ratios(h, w)`` its evidence and its mean; then the log length."""
    words = [ids(t) for t in texts]
    w = np.concatenate(words) if words else np.empty(0, np.int64)
    h = np.concatenate([contexts(x) for x in words if len(x)]) if len(w) else w
    every, end, out = ratios(h, w), 0, []
    for x in words:
        begin, end = end, end + len(x)
        out.append([f for r in every for f in (evidence(r[begin:end]), float(r[begin:end].mean()) if len(x) else 0.0)]
                   + [float(np.log1p(len(x)))])
    return out


def chunked(docs: DataFrame, chunk: str, text: str, size: int) -> DataFrame:
    """``docs`` with a chunk's number on consecutive rows of about ``size`` bytes of text."""
    number = f"{chunk}_part"

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = 0
        for batch in batches:
            column = batch.column(text)
            cost = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + ROW
            ends = held + np.cumsum(cost)
            held = int(ends[-1]) if len(ends) else held
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((ends - cost) // size)],
                                             names=[*batch.schema.names, number])

    named = docs.withColumn(chunk, F.spark_partition_id().cast("long")).mapInArrow(
        name, StructType([*docs.schema.fields, StructField(chunk, LongType()), StructField(number, LongType())]))
    return named.withColumn(chunk, F.col(chunk) * (1 << 40) + F.col(number)).drop(number)


def bloom(keys: DataFrame) -> np.ndarray:
    """A bitmap of BLOOM_BITS with the bits of all ``key``; built in blocks, 8 MB in all."""
    def block(part: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(BLOOM_BLOCK, dtype=np.uint8)
        bits[part["bit"].to_numpy()] = 1
        return pd.DataFrame({"block": part["block"].iloc[:1], "bits": [np.packbits(bits).tobytes()]})

    slot = F.col("key").bitwiseAND(F.lit(BLOOM_BITS - 1))
    parts = (keys.select((slot / BLOOM_BLOCK).cast("int").alias("block"), (slot % BLOOM_BLOCK).cast("int").alias("bit"))
             .distinct().groupBy("block").applyInPandas(block, "block int, bits binary").collect())
    out = np.zeros((BLOOM_BITS // BLOOM_BLOCK, BLOOM_BLOCK // 8), dtype=np.uint8)
    for number, bits in parts:
        out[number] = np.frombuffer(bits, dtype=np.uint8)
    return out.reshape(-1)


def joined(docs: DataFrame, table: DataFrame, ratios: Callable, features: int, text: str = "text",
           size: int = CHUNK, pass_bits: np.ndarray | None = None) -> tuple[DataFrame, str]:
    """``docs`` with an array of features of each text, where the table meets the texts by a join."""
    scratch = Scratch(docs.sparkSession, "kneser-chunks")
    chunk, into = unused(docs, "_chunk", "_features")
    written = scratch.cut(chunked(docs, chunk, text, size))
    columns = [c for c in table.columns if c != "key"]

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordKeys()
        for batch in batches:
            numbers, texts = batch.column(chunk).to_numpy(), batch.column(text).to_pylist()
            for number in np.unique(numbers).tolist():
                words = [w for at in np.flatnonzero(numbers == number) if len(w := ids(texts[at]))]
                if not words:
                    continue
                w, h = np.concatenate(words), np.concatenate([contexts(w) for w in words])
                key = np.unique(np.r_[np.int64(START), w, pair_hash(h, w)])
                if pass_bits is not None:
                    slot = key & (BLOOM_BITS - 1)
                    key = key[(pass_bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), number)), pa.array(key)],
                                                 names=["chunk", "key"])

    def answered(rows: pa.Table, known: pa.Table) -> pa.Table:
        key, first = np.unique(known["key"].to_numpy(), return_index=True)
        arrays = {"key": key, **{c: known[c].to_numpy()[first] for c in columns}}
        got = of_texts(rows[text].to_pylist(), WordKeys(), lambda h, w: ratios(h, w, arrays))
        return rows.drop_columns([chunk]).append_column(into, pa.array(got, pa.list_(pa.float64())))

    known = (written.select(chunk, text).mapInArrow(asked, "chunk long, key long")
             .join(table, "key").select("chunk", "key", *columns))
    schema = StructType([*docs.schema.fields, *StructType.fromDDL(f"`{into}` array<double>").fields])
    return written.groupBy(chunk).cogroup(known.groupBy("chunk")).applyInArrow(answered, schema), into


def weighed(docs: DataFrame, model: Model, size: int = CHUNK) -> tuple[DataFrame, str]:
    """``docs`` with the features of each text for all discounts of the model."""
    facts = replace(model, pairs=None, words=None, table=None)      # what tasks get: sums
    return joined(docs, model.known(), lambda h, w, known: counted_ratios(h, w, known, facts),
                  2 * len(model.discounts) * (1 + len(model.pair_discounts)) + 1, size=size)


def in_place(text: Column, keys: Broadcast) -> Column:
    """The features of each text from a table that was sent to the tasks; the text moves nowhere."""
    @F.pandas_udf("array<double>")
    def features(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ids = WordKeys()
        for batch in texts:
            out = []
            for at in range(0, len(batch), TEXTS):
                out += of_texts(list(batch[at:at + TEXTS]), ids, lambda h, w: tabled_ratios(h, w, keys.value))
            yield pd.Series(out)

    return features(text)


def sorted_columns(table: DataFrame, rows: int) -> dict[str, np.ndarray]:
    """The scoring table's columns by key; the driver holds them once, and one part of the rows beside them."""
    key, ratio, end = np.empty(rows, np.int64), np.empty(rows), 0
    parts = max(1, math.ceil(rows / PART_ROWS))
    for part in range(parts):
        some = table.where(F.pmod("key", F.lit(parts)) == part).toArrow()
        begin, end = end, end + len(some)
        key[begin:end], ratio[begin:end] = some["key"].to_numpy(), some["ratio"].to_numpy()
    order = np.argsort(key)
    for column in (key, ratio):
        column[:] = column[order]
    return {"key": key, "ratio": ratio}


def fit_curve(x: np.ndarray, toxic: np.ndarray) -> tuple[float, np.ndarray]:
    """Logistic regression by Newton's method: its log-likelihood, its coefficients."""
    beta, ridge = np.zeros(x.shape[1]), 1e-3
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (toxic - p) - ridge * beta
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(bend, slope)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    z = np.clip(x @ beta, -30, 30)
    return float((toxic * z - np.log1p(np.exp(z))).sum()), beta


def train(docs: DataFrame, labels: DataFrame, curve_rows: int = 20_000) -> Model | None:
    """Count all labelled training rows and fit the curve; None without both classes.

    Labels of documents whose crc32(doc_id) mod 5 is 0 are never read. Those with
    remainder 4 are left out of the counts; of them at most ``curve_rows`` (by hash of
    the id) fit the curve.
    """
    scratch = Scratch(docs.sparkSession, "kneser-tables")
    part = fold(F.col("doc_id"), 5)
    known = (labels.where("toxic is not null and doc_id is not null").where(part != 0)
             .select("doc_id", (F.col("toxic") == 1).cast("int").alias("toxic")))
    # the labels meet the texts by a broadcast while their files are small, else by a shuffle
    known = bounded_broadcast(known, BROADCAST_BYTES)
    texts = docs.where("doc_id is not null").select("doc_id", "text")
    model = count(texts.where(part.isin(1, 2, 3)).join(known.where(part != 4), "doc_id").select("text", "toxic"),
                  scratch)
    if model is None:
        return None
    ids = known.where(part == 4).orderBy(F.xxhash64("doc_id"), "toxic").limit(curve_rows)
    rows = texts.where(part == 4).join(ids, "doc_id").select("text", "toxic")
    weights, features = weighed(rows, model)
    held = weights.select("toxic", features).toArrow()      # columns, not a Python object for each number
    d, e, curve = 0, 0, (0.0, 1.0, 0.0, 0.0, 0.0)      # too few rows for a curve: the ratio itself
    toxic = held["toxic"].to_numpy().astype(float)
    if len(np.unique(toxic)) == 2:
        x = pc.list_flatten(held[features]).to_numpy().reshape(len(toxic), -1)
        n, fits = len(DISCOUNTS), {}
        for i in range(n):
            for j in range(len(PAIR_DISCOUNTS)):
                pair = 2 * (n * (j + 1) + i)
                fits[i, j] = fit_curve(np.c_[x[:, 2 * i], x[:, pair], x[:, pair + 1], x[:, -1], np.ones(len(x))], toxic)
        d, e = max(fits, key=lambda at: fits[at][0])
        curve = tuple(map(float, fits[d, e][1]))
    d, e = DISCOUNTS[d], PAIR_DISCOUNTS[e]
    table = scratch.cut(model.ratios(d, e))
    scratch.drop(model.pairs, model.words)
    return replace(model, pairs=None, words=None, discounts=(d,), pair_discounts=(e,), curve=curve, table=table,
                   rows=table.count())


def scored(docs: DataFrame, model: Model | None, into: str = "score", ratio: str | None = None,
           size: int = CHUNK, table_rows: int = TABLE_ROWS) -> DataFrame:
    """``docs`` with a score from 0 to 1 of each text, and its plain log ratio as ``ratio``."""
    if model is None:
        return docs.withColumns({into: F.lit(0.0), **({ratio: F.lit(0.0)} if ratio else {})})
    if model.rows <= table_rows:
        sent = docs.sparkSession.sparkContext.broadcast(sorted_columns(model.table, model.rows))
        features, = unused(docs, "_features")
        out = docs.withColumn(features, in_place(F.col("text"), sent))
    else:
        out, features = joined(docs, model.table, tabled_ratios, 5, size=size, pass_bits=bloom(model.table))
    # evidence and mean of words, then of pairs; the log length
    x = [F.get(features, F.lit(i)) for i in (0, 2, 3, 4)]
    line = sum((F.lit(b) * v for b, v in zip(model.curve, x)), F.lit(model.curve[-1]))
    bounded = F.greatest(F.lit(-500.0), F.least(F.lit(500.0), -line))
    more = {ratio: F.get(features, F.lit(3))} if ratio else {}
    return out.withColumns({into: 1 / (1 + F.exp(bounded)), **more}).drop(features)
