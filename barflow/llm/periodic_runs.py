"""Periodic runs of words, found online by catchers over dyadic blocks.

A run is a stretch of words with smallest period q that no neighbouring word extends,
at least ``EXPONENT`` periods and ``SHORTEST`` words long.

``Catchers`` takes words as they are appended. Level H (a power of two) looks for
periods q in [H, 2H). Each completed pair of neighbouring blocks of H words is a catcher:
it waits for its own words to come again q words later. Appended words complete windows
of 2H words, and each window is compared with the one catcher that can have it at such a
distance. A hit is a square in the making: its suffix comparison (word against the word q
before) goes to the left at once and to the right as far as words are there, and goes on
with each append while it lasts. Hits of one period inside a stretch already followed
merge into it.

Why this is whole: where words repeat after q over a run of 4q, the words that have their
equal q later are 3q >= 3H long and contain a whole catcher. A catcher of 2H words that
comes again at two distances has a period below H itself, so of its hits only the
farthest can be a smallest period, and one hit a catcher (and append) is followed. Equal
hashes only propose; words decide. A stretch whose period is a multiple of a smaller one
has the limits of that smaller one's run, and is dropped for it.

Each level compares each word once, so a text of n words takes n log n steps on arrays; a
text is held by one task, other texts are not.

Defined results: null, empty and blank texts have no words and no runs; texts are split
at ASCII blanks only; repeated rows each get their result; an empty table gives an empty
result. Columns other than the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

EXPONENT = 4
SHORTEST = 6
APPEND = 1 << 14         # words appended at once
BASE = np.uint64(0x9E3779B97F4A7C15)
WORDS = r"[^\x20\x09-\x0D]+"


class Catchers:
    """Runs of a growing sequence of word numbers."""

    def __init__(self):
        self.words = np.empty(APPEND, dtype=np.int64)
        self.prefix = np.zeros(APPEND + 1, dtype=np.uint64)      # sum of the first words' terms
        self.power = np.ones(APPEND + 1, dtype=np.uint64)
        self.n = 0
        self.seen: list[int] = []            # by level: windows compared so far
        self.open: dict[int, tuple[int, int]] = {}       # period: start and end of what repeats
        self.last: dict[int, int] = {}       # period: end of the last closed stretch
        self.found: dict[tuple[int, int], int] = {}      # (start, end): least period

    def append(self, words: np.ndarray) -> None:
        """Words join the end; every catcher and open comparison advances."""
        self._grow(words)
        for period in list(self.open):
            self._advance(period)
        level, size = 0, 1
        while 3 * size <= self.n:
            if level == len(self.seen):
                self.seen.append(size)       # the first window that a catcher precedes
            self._catch(level, size)
            level, size = level + 1, 2 * size

    def finish(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs, by start, then period."""
        for period in list(self.open):
            self._close(period)
        return sorted(((start, end - start, period) for (start, end), period in self.found.items()),
                      key=lambda run: (run[0], run[2]))

    def _grow(self, words: np.ndarray) -> None:
        n, m = self.n, self.n + len(words)
        if m > len(self.words):
            room = max(m, 2 * len(self.words))
            for name in ("words", "prefix", "power"):
                old = getattr(self, name)
                new = np.empty(room + (name != "words"), dtype=old.dtype)
                new[:len(old)] = old
                setattr(self, name, new)
        self.words[n:m] = words
        with np.errstate(over="ignore"):
            steps = np.full(len(words), BASE, dtype=np.uint64)
            self.power[n + 1:m + 1] = self.power[n] * np.multiply.accumulate(steps)
            terms = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
            terms ^= terms >> np.uint64(29)
            self.prefix[n + 1:m + 1] = self.prefix[n] + np.add.accumulate(terms * self.power[n:m])
        self.n = m

    def _catch(self, level: int, size: int) -> None:
        """Compare the windows completed since with their catchers."""
        first, stop = self.seen[level], self.n - 2 * size + 1
        if stop <= first:
            return
        self.seen[level] = stop
        at = np.arange(first, stop)
        catcher = (at // size - 1) * size
        window = self.prefix[first + 2 * size:stop + 2 * size] - self.prefix[first:stop]
        known = self.prefix[catcher + 2 * size] - self.prefix[catcher]
        hits = np.flatnonzero(window == known * self.power[at - catcher])
        if not len(hits):
            return
        catcher = catcher[hits]
        farthest = np.flatnonzero(np.r_[catcher[1:] != catcher[:-1], True])
        for block, where in zip(catcher[farthest].tolist(), at[hits[farthest]].tolist()):
            self._follow(block, where - block, size)

    def _follow(self, block: int, period: int, size: int) -> None:
        """Compare on from a catcher's words [block, block + 2 size) and those a period later."""
        if period in self.open or block < self.last.get(period, 0):
            return
        w = self.words
        if not np.array_equal(w[block:block + 2 * size], w[block + period:block + period + 2 * size]):
            return
        start, step = block, 16
        while start:
            low = max(0, start - step)
            differ = np.flatnonzero(w[low:start] != w[low + period:start + period])
            if len(differ):
                start = low + int(differ[-1]) + 1
                break
            start, step = low, 2 * step
        self.open[period] = start, block + 2 * size
        self._advance(period)

    def _advance(self, period: int) -> None:
        """Compare to the right as far as words are there; close at the first that differs."""
        start, end = self.open[period]
        w, stop, step = self.words, self.n - period, 16
        while end < stop:
            high = min(stop, end + step)
            differ = np.flatnonzero(w[end:high] != w[end + period:high + period])
            if len(differ):
                self.open[period] = start, end + int(differ[0])
                self._close(period)
                return
            end, step = high, 2 * step
        self.open[period] = start, end

    def _close(self, period: int) -> None:
        start, repeats = self.open.pop(period)
        self.last[period] = repeats
        end = repeats + period
        if end - start >= max(SHORTEST, EXPONENT * period):
            self.found[start, end] = min(period, self.found.get((start, end), period))


def runs_of(words: list[bytes], at_once: int = APPEND) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one text's words."""
    if len(words) < SHORTEST:
        return []
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    if len(number) == len(words):
        return []
    catchers = Catchers()
    for at in range(0, len(ids), at_once):
        catchers.append(ids[at:at + at_once])
    return catchers.finish()


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words but those that some run repeats: in it, after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [w for w, d in zip(words, np.cumsum(drop)[:-1].tolist()) if not d]


def find_runs(text: Column) -> Column:
    """struct<words: long, runs: array<struct<start, length, period>>, collapsed: string>.

    ``collapsed`` is the text with each run cut to its first period, joined by one
    space; null where there is no run.
    """
    @F.pandas_udf("words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    def found(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            out = []
            for t in batch:
                words = (t or "").encode("utf-8", "surrogatepass").split()
                runs = runs_of(words)
                out.append((len(words), [dict(start=s, length=n, period=p) for s, n, p in runs],
                            b" ".join(kept_words(words, runs)).decode("utf-8", "surrogatepass")
                            if runs else None))
            yield pd.DataFrame(out, columns=["words", "runs", "collapsed"])

    return found(text)


def words_joined(text: Column) -> Column:
    """The words of a text joined by one space; empty for null."""
    blank = F.lit(" \t\n\x0b\x0c\r")
    return F.regexp_replace(F.btrim(F.coalesce(text, F.lit("")), blank), r"[\x20\x09-\x0D]+", " ")


def planted(text: Column, doc_id: Column) -> Column:
    """Whole text, or, for a tenth of the ids, its words repeating from a place on.

    With h = crc32(decimal doc_id), g = floor(h / 10): where h % 10 is 0 and the text has
    n > 0 words, word i >= a becomes word a + (i - a) % p, a = g % n and
    p = 1 + floor((n - a) / (3 + g % 8)). A null id plants nothing.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeating(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        return F.array_join(F.concat(
            F.slice(words, F.lit(1), a.cast("int")),
            F.transform(F.sequence(F.lit(0), (n - a - 1).cast("int")),
                        lambda i: F.get(words, (a + i % p).cast("int")))), " ")

    # as a lambda's variable the words are split once, not once for each of them
    words = F.array(F.regexp_extract_all(text, F.lit(WORDS), F.lit(0)))
    return F.when((h % 10 == 0) & F.coalesce(F.regexp_like(text, F.lit(WORDS)), F.lit(False)),
                  F.get(F.transform(words, repeating), F.lit(0))).otherwise(text)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; ties: start, then period."""
    def better(a: Column, b: Column) -> Column:
        mine, other = a["length"] * b["period"], b["length"] * a["period"]
        return (mine > other) | ((mine == other) & (
            (a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["period"] < b["period"]))))

    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(better(r, best), r).otherwise(best))
