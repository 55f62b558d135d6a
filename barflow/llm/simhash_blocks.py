"""Document fingerprints: weighted SimHash with permuted block tables.

Terms are neighbouring word pairs of the lower-cased text (the word itself in a
text of one word). Each distinct term's XXH64 votes on the 64 bits, for a set bit
and against a clear one, with weight 16 (1 + ln count), rounded; a bit is set
where the votes are in favour. Likeness of two fingerprints is the cosine that
their Hamming distance estimates, max(0, cos(pi d / 64)): 1 for equal
fingerprints, about 0 for unrelated texts.

Tables: the 64 bits lie in ``blocks`` blocks; for every choice of ``blocks -
radius`` blocks a table holds all fingerprints permuted so that those blocks come
first. Two fingerprints within ``radius`` bits agree on the front of at least one
table, whatever bits differ, so looking up equal fronts finds all of them.

Defined results: null, empty and blank texts have fingerprint 0; equal texts have
equal fingerprints; repeated rows each get a row; an empty table gives an empty
result. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import Scratch
from barflow.llm.links import MASK64, bit_distance, bucket_links, components, signed

CHUNK = 1 << 15
RUN_DOCS = 500           # documents in a run of neighbours
MAX_RUNS = 65_536


def simhash(text: str | None) -> int:
    """The fingerprint of one text, unsigned."""
    import xxhash

    words = (text or "").lower().encode("utf-8", "surrogatepass").split()
    if not words:
        return 0
    terms = Counter(map(b" ".join, zip(words, words[1:])) if len(words) > 1 else words)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(map(digest, terms), dtype="<u8", count=len(terms))
    counts = np.fromiter(terms.values(), dtype=np.float64, count=len(terms))
    weights = np.rint(16 * (1 + np.log(counts)))       # whole numbers: sums are exact
    votes = np.zeros(64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at:at + CHUNK].view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(part, axis=1, bitorder="little").astype(np.float64)
        votes += weights[at:at + CHUNK] @ (2 * bits - 1)
    return int(np.packbits(votes > 0, bitorder="little").view("<u8")[0])


def fingerprint(text: Column) -> Column:
    @F.pandas_udf("long")
    def fingerprints(texts: pd.Series) -> pd.Series:
        return pd.Series([signed(simhash(t)) for t in texts], dtype="int64")

    return fingerprints(F.coalesce(text, F.lit("")))


def likeness(a: int, b: int) -> float:
    return max(0.0, math.cos(math.pi * ((a ^ b) & MASK64).bit_count() / 64))


# ------------------------------------------------------------ tables
def block_masks(blocks: int, radius: int) -> list[int]:
    """The bits that make the front of each table."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
    return [signed(sum(kept)) for kept in combinations(parts, blocks - radius)]


def table_rows(fps: DataFrame, blocks: int, radius: int) -> DataFrame:
    """(fp, t, key): each fingerprint's front in every table."""
    if blocks <= radius:
        raise ValueError("blocks must exceed the radius")
    masks = F.array(*[F.lit(m) for m in block_masks(blocks, radius)])
    return (fps.select("fp", F.posexplode(masks).alias("t", "mask"))
            .select("fp", "t", F.col("fp").bitwiseAND(F.col("mask")).alias("key")))


def within(queries: DataFrame, fps: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """(query, fp, bits): every fingerprint of ``fps`` within the radius of each query.

    Both inputs hold distinct longs ``fp``. Only equal fronts meet, and a pair that
    meets in several tables is kept in the first of them alone.
    """
    masks = block_masks(blocks, radius)
    left = table_rows(queries, blocks, radius).withColumnRenamed("fp", "query")
    met = left.join(table_rows(fps, blocks, radius), ["t", "key"])
    apart = F.col("query").bitwiseXOR(F.col("fp"))
    first = F.coalesce(*[F.when(apart.bitwiseAND(F.lit(m)) == 0, F.lit(t)) for t, m in enumerate(masks)])
    bits = bit_distance(F.col("query"), F.col("fp"))
    return met.where((bits <= radius) & (first == F.col("t"))).select("query", "fp", bits.alias("bits"))


def classes(fps: DataFrame, scratch: Scratch, radius: int = 2, blocks: int = 6,
            max_bucket: int = 16) -> DataFrame:
    """(fp, class): the smallest fingerprint reachable over links within the radius."""
    links = bucket_links(scratch, fps, table_rows(fps, blocks, radius), radius,
                         lambda a, b: F.lit(True), max_bucket)
    roots = scratch.cut(components(scratch, links), links)
    return scratch.cut(fps.join(roots, fps["fp"] == roots["node"], "left")
                       .select("fp", F.coalesce("root", "fp").alias("class")), roots)


# ------------------------------------------------------------ edited neighbours
def run_bounds(docs: DataFrame) -> list[int]:
    """Ids that cut the id-ordered documents into runs of about RUN_DOCS."""
    n = docs.count()
    runs = min(MAX_RUNS, max(1, math.ceil(n / RUN_DOCS)))
    if runs == 1:
        return []
    shares = [i / runs for i in range(1, runs)]
    cuts = docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 4 * runs))).first()[0]
    return sorted(set(cuts or []))


def edited(docs: DataFrame) -> DataFrame:
    """One row per document: its text beside the edited one, in fingerprints.

    The edited text is the text with its last floor(n / 2) code points replaced by
    the first as many (or all) of the next document: descending doc_id, null ids
    last, rows of one id by text; after the last comes the first.

    Documents are dealt into runs of neighbouring ids, each a sorted sequence; the
    first row of the next run is dealt to the run before it as well. Texts so
    cross the network once, and a task holds one pair of them at a time. At most
    MAX_RUNS bounds and first ids pass through the driver.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    bounds = np.array(run_bounds(docs), dtype=np.int64)

    @F.pandas_udf("int")
    def run_of(ids: pd.Series) -> pd.Series:
        known = ids.notna()
        out = np.zeros(len(ids), dtype=np.int32)
        out[known] = np.searchsorted(bounds, ids[known].to_numpy(dtype=np.int64), "right")
        return pd.Series(out)

    heads = sorted(docs.select("doc_id", run_of("doc_id").alias("run")).groupBy("run")
                   .agg(F.max("doc_id").alias("first")).collect(), key=lambda r: -r.run)
    # the run that reads each head's row after its own last one
    reader = {after.first: before.run for before, after in zip(heads, heads[1:] + heads[:1])}

    def fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            fps = pa.array([signed(simhash(t)) for t in texts.to_pylist()], pa.int64())
            own = [0 if i is None else int(np.searchsorted(bounds, i, "right")) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int32()), pa.array([False] * len(ids)), batch.column(0), texts, fps],
                names=["run", "guest", "doc_id", "text", "fp"])
            heading = [k for k, i in enumerate(ids) if i in reader]
            if heading:
                at = pa.array(heading, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([reader[ids[k]] for k in heading], pa.int32()),
                     pa.array([True] * len(heading)), batch.column(0).take(at), texts.take(at),
                     fps.take(at)], names=["run", "guest", "doc_id", "text", "fp"])

    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                        ("fp", pa.int64()), ("edited_fp", pa.int64()), ("near_edited", pa.float64()),
                        ("near_next", pa.float64())])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out = []
            cols = [c.to_pylist() for c in batch.columns]
            for run, guest, doc_id, text, fp in zip(*cols):
                if held is not None and held[0] == run and not held[1]:
                    _, _, own_id, own, own_fp = held
                    half = len(own) // 2
                    new = own[:len(own) - half] + text[:half]
                    new_fp = signed(simhash(new))
                    out.append((own_id, len(own), hashlib.sha256(new.encode("utf-8")).hexdigest(),
                                own_fp, new_fp, likeness(own_fp, new_fp), likeness(own_fp, fp)))
                held = run, guest, doc_id, text, fp
            yield pa.RecordBatch.from_pylist(
                [dict(zip(schema.names, row)) for row in out], schema=schema)

    dealt = (docs.mapInArrow(fingerprinted, "run int, guest boolean, doc_id long, text string, fp long")
             .repartition("run")
             .sortWithinPartitions("run", "guest", F.col("doc_id").desc_nulls_last(), "text"))
    return dealt.mapInArrow(compared, "doc_id long, n_chars long, edited_sha256 string, fp long, "
                                      "edited_fp long, near_edited double, near_next double")


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def fingerprints(docs: DataFrame, radius: int = 2, blocks: int = 6) -> DataFrame:
    """``edited`` with hex fingerprints and each document's class of near fingerprints."""
    scratch = Scratch(docs.sparkSession, "simhash-blocks")
    rows = scratch.cut(edited(docs))
    fps = scratch.cut(rows.select("fp").distinct())
    near = classes(fps, scratch, radius, blocks)
    return rows.join(near, "fp").select(
        "doc_id", "n_chars", "edited_sha256", as_hex(F.col("fp")).alias("fingerprint"),
        as_hex(F.col("edited_fp")).alias("edited_fingerprint"), "near_edited", "near_next",
        as_hex(F.col("class")).alias("class_fingerprint"))
