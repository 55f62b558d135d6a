"""Language identification by compression.

Only words count: texts are lower-cased and reduced to their runs of letters, one
space apart, without immediate repeats, for dictionaries and judged texts alike; so
capitals, digits, marks and repeated words tell nothing.

Every learned language gets a zstandard raw-content dictionary: words of its
training documents, at most ``dictionary_bytes`` of them. A text is cut into pieces of
PIECE_BYTES, all of them, so that each meets the dictionary and not only itself;
each piece is compressed with every language's dictionary, and the language with
the smallest sum wins. Equal sums go to the language whose dictionary saves most
at a second, stronger level, then to the one with more training documents, then by
name. The margin is the share by which the runner-up is larger; a margin below
``reject_below`` marks the row as rejected, while the best language stays stated.
The score is the margin's odds in bits a character, squeezed to 0..1.

The sample that fills a dictionary is bounded and documented: of each language the
``sample_docs`` training documents with the smallest hash of id and text, each giving
at most its share of the dictionary (long ones more where short ones leave room). Everything else covers all documents.

Defined results: null texts and texts without a letter give ``und`` with score 0;
if nothing can be learned, every text does; repeated rows get equal results; an
empty table gives an empty result. Columns other than those named are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barflow.llm.common import fold

PIECE_BYTES = 4096
LEVEL, TIE_LEVEL = 9, 15


def learn(docs: DataFrame, sample_docs: int = 256, dictionary_bytes: int = 400 * 1024) -> dict[str, bytes]:
    """Language -> dictionary, the language with most training documents first.

    Training rows: non-null lang and text, crc32(doc_id) mod 4 not 2. Of each language
    ``sample_docs`` texts, drawn by hash, fill the dictionary; a text longer than four
    times its share of it gives one piece of that length, drawn by the text's hash.
    """
    rows = docs.where("lang is not null and text is not null and text <> ''").where(
        fold(F.col("doc_id"), 4) != 2)
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return {}
    share = dictionary_bytes // max(1, sample_docs)
    # about four times the sample passes a language's cut, however many rows there are;
    # only those meet in one task to be ranked
    cuts = F.create_map(*[F.lit(v) for lang, n in sizes.items()
                          for v in (lang, int((1 << 30) * min(1.0, 4 * sample_docs / n)))])
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    # of a longer text the piece that its hash picks: any place of it may be drawn
    room = F.greatest(F.lit(1), F.length("text") - 4 * share + 1)
    piece = F.substr("text", (F.pmod(F.xxhash64("text"), room) + 1).cast("int"), F.lit(4 * share))
    ranked = (rows.select("lang", piece.alias("text"), place.alias("h"))
              .where(F.col("h") < F.element_at(cuts, F.col("lang")))
              .withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))))
    sample = ranked.where(F.col("k") <= sample_docs).collect()
    out = {}
    for lang in sorted(sizes, key=lambda x: (-sizes[x], x)):
        texts = [words_of(r.text) for r in sorted(sample, key=lambda r: r.k) if r.lang == lang]
        # long texts give more where short ones leave room
        left, parts = dictionary_bytes, []
        for i, t in enumerate(sorted(texts, key=len)):
            parts.append(t[:left // (len(texts) - i)])
            left -= len(parts[-1])
        out[lang] = b" ".join(parts)
    return out


LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> bytes:
    return " ".join(w for w, _ in groupby(LETTERS.findall(text.lower()))).encode("utf-8", "replace")


class Compressors:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.names, self.contents = list(dictionaries), list(dictionaries.values())
        self.fast = self.at(LEVEL)

    @cached_property
    def strong(self) -> list:
        return self.at(TIE_LEVEL)        # made where a tie asks for it

    def at(self, level: int) -> list:
        import zstandard as z

        made = []
        for content in self.contents:
            d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            made.append(z.ZstdCompressor(dict_data=d, level=level, write_content_size=False,
                                         write_checksum=False, write_dict_id=False))
        return made

    @staticmethod
    def sizes(compressors: list, data: bytes) -> np.ndarray:
        pieces = [data[i:i + PIECE_BYTES] for i in range(0, len(data), PIECE_BYTES)]
        return np.array([sum(len(c.compress(p)) for p in pieces) for c in compressors], dtype=np.int64)

    def judge(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and margin of one text."""
        if not text or not self.names or not any(map(str.isalpha, text)):
            return "und", 0.0, 0.0
        data = words_of(text)
        sizes = self.sizes(self.fast, data)
        order = np.argsort(sizes, kind="stable")
        if len(order) > 1 and sizes[order[0]] == sizes[order[1]]:
            second = self.sizes(self.strong, data)
            order = np.lexsort((np.arange(len(sizes)), second, sizes))
        best = order[0]
        if len(order) == 1:
            return self.names[best], 1.0, 1.0
        gap = float(sizes[order[1]] - sizes[best])
        score = 1 / (1 + 2.0 ** -min(60.0, 8 * gap / max(1.0, len(data) ** 0.5)))
        return self.names[best], score, gap / float(sizes[order[1]])


def identify(text: Column, dictionaries: dict[str, bytes], reject_below: float = 0.01) -> Column:
    """struct<lang, score, margin, rejected> of each text."""
    @F.pandas_udf("lang string, score double, margin double, rejected boolean")
    def judged(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tools = Compressors(dictionaries)
        for batch in texts:
            rows = [tools.judge(t) for t in batch]
            yield pd.DataFrame([(lang, score, margin, margin < reject_below)
                                for lang, score, margin in rows],
                               columns=["lang", "score", "margin", "rejected"])

    return judged(text)
