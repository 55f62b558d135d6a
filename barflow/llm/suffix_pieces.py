"""SentencePiece encoding and decoding through suffix-array matching.

The vocabulary file is a byte-fallback BPE model. A text becomes ``"▁"`` plus the
text with spaces as ``"▁"``, cut into units before each run of ``"▁"`` and between
letters and other characters. No piece of the vocabulary lies across a cut, which
loading it verifies, so no merge does.

For every batch the units that are new to the task are concatenated and indexed
by a suffix array (suffixes are compared up to the longest piece). Each piece is
found by binary search; its range of the array lists its occurrences. These
edges are sorted by position, longest first, and a unit is relaxed from left to
right over edges that agree with the piece before them.

A plain shortest path would give the unigram segmentation, which is wrong for a
BPE vocabulary. The edge test is therefore BPE's own: two neighbouring pieces
agree if undoing their merges, latest first, never meets a merge across their
border that BPE would have made earlier. A path whose neighbours all agree is the
BPE encoding, and there is just one, so the ids equal the reference library's.

Characters outside the vocabulary become their UTF-8 bytes' pieces. Decoding
joins pieces and bytes, turns "▁" to spaces and drops the first one. Every text
survives the round trip, but that "▁" itself comes back as a space.

Defined results: null and empty texts have no ids and decode to the empty text;
repeated rows get equal ids; an empty table gives an empty result. Columns other
than doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
# "▁" and letters, "▁" and anything else, "▁" alone; cuts depend on two neighbours only
UNIT = re.compile(rf"{SPACE}*(?:[^\W\d_²]+|(?:[^\w{SPACE}]|[\d_²])+)|{SPACE}+")
KNOWN_UNITS = 150_000        # units in a generation of those a task remembers
SLICE_CHARS = 2_000_000      # characters encoded at once
TEXTS = 512                  # texts taken out of a batch at once


class Vocabulary:
    """Pieces in the order of merging: characters first, then by score.

    ``parts`` holds the two pieces that the last merge of a piece joins.
    """

    def __init__(self, pieces: list[str], scores: list[float], ids: list[int], byte_ids: list[int]):
        order = sorted(range(len(pieces)), key=lambda i: (len(pieces[i]) > 1, -scores[i], i))
        self.pieces = [pieces[i] for i in order]
        self.ids = [ids[i] for i in order]
        self.rank = {p: r for r, p in enumerate(self.pieces)}
        self.byte_ids = byte_ids
        self.parts: list[tuple[int, int] | None] = []
        for r, p in enumerate(self.pieces):
            self.parts.append((r, r) if len(p) == 1 else self._last_merge(p, r))

    def _last_merge(self, piece: str, r: int) -> tuple[int, int] | None:
        """None if BPE of the piece's own text does not end in the piece."""
        rank, at = self.rank, list(piece)
        last = None
        while len(at) > 1:
            best = min((rank.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(at, at[1:])))
            if best[0] == 1 << 60:
                return None
            i = best[1]
            last = (rank.get(at[i]), rank.get(at[i + 1]))
            at[i:i + 2] = [at[i] + at[i + 1]]
        return None if last is None or None in last or rank[at[0]] != r else last

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        all_ids = range(model.vocab_size())
        normal = [i for i in all_ids if not (model.is_unknown(i) or model.is_control(i)
                                             or model.is_byte(i) or model.is_unused(i))]
        pieces = [model.id_to_piece(i) for i in normal]
        if any(UNIT.findall(p) != [p] for p in pieces):
            raise ValueError("a piece lies across a cut between units")
        by_byte = {int(model.id_to_piece(i)[3:-1], 16): i for i in all_ids if model.is_byte(i)}
        if len(by_byte) != 256:
            raise ValueError("the model has no byte fallback")
        return cls(pieces, [model.get_score(i) for i in normal], normal,
                   [by_byte[b] for b in range(256)])


class SuffixMatcher:
    """Finds every occurrence of every piece of two or more characters in a batch."""

    def __init__(self, vocabulary: Vocabulary):
        self.words = [(p, r) for r, p in enumerate(vocabulary.pieces)
                      if len(p) > 1 and vocabulary.parts[r] is not None]
        self.longest = max(len(p) for p, _ in self.words)
        chars = sorted({c for p, _ in self.words for c in p})
        self.codes = np.array([ord(c) for c in chars], dtype=np.int64)
        grid = np.zeros((len(self.words), self.longest), dtype=np.int64)
        for i, (p, _) in enumerate(self.words):
            grid[i, :len(p)] = np.searchsorted(self.codes, [ord(c) for c in p]) + 1
        self.grid = grid
        self.lengths = np.array([len(p) for p, _ in self.words])
        self.ranks = np.array([r for _, r in self.words])

    def edges(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(first, ranks): the pieces at position i are ranks[first[i]:first[i + 1]], longest first."""
        points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.int64)
        at = np.minimum(np.searchsorted(self.codes, points), len(self.codes) - 1)
        letter = np.where(self.codes[at] == points, at + 1, 0)      # 0: in no piece
        used = np.unique(letter[letter > 0])
        if not len(used):
            return np.zeros(len(points) + 1, dtype=np.int64), np.empty(0, dtype=np.int64)
        dense = np.zeros(len(self.codes) + 2, dtype=np.int64)
        dense[used] = np.arange(1, len(used) + 1)
        # pieces whose letters all occur; the others have no occurrence
        here = np.flatnonzero(((self.grid == 0) | (dense[self.grid] > 0)).all(axis=1))
        grid, lengths = dense[self.grid[here]], self.lengths[here]
        bits = int(len(used) + 1).bit_length()
        per = 1 << (62 // bits).bit_length() - 1        # letters in one key
        words = -(-self.longest // per)

        def widened(letters: np.ndarray, axis: int) -> np.ndarray:
            """From each place, the next ``per`` letters in one number, by doubling."""
            key, held = letters, 1
            while held < per:
                later = np.zeros_like(key)
                if axis:
                    later[:, :-held] = key[:, held:]
                else:
                    later[:-held] = key[held:]
                key = (key << (bits * held)) | later
                held *= 2
            return key

        # a break is 0 and sorts before every letter, so no piece's range reaches over it
        n, pad = len(points), self.longest + per
        key = widened(np.r_[dense[letter], np.zeros(pad, dtype=np.int64)], 0)
        suffix = [key[k * per:n + k * per] for k in range(words)]
        order = np.lexsort(suffix[::-1]) if words > 1 else np.argsort(suffix[0])
        kind = np.dtype([(f"k{i}", ">i8") for i in range(words)])

        def text_keys(keys: list[np.ndarray]) -> np.ndarray:
            """Keys as byte strings of one width, whose order is that of the keys."""
            rows = np.empty(len(keys[0]), dtype=kind)
            for i, k in enumerate(keys):
                rows[f"k{i}"] = k
            return rows.view(f"S{8 * words}")

        def piece_keys(fill: int) -> np.ndarray:
            wide = np.zeros((len(here), words * per), dtype=np.int64)
            wide[:, :self.longest] = grid
            wide[np.arange(words * per)[None, :] >= lengths[:, None]] = fill
            return text_keys([widened(wide[:, k * per:(k + 1) * per], 1)[:, 0] for k in range(words)])

        index = text_keys([k[order] for k in suffix])
        first = np.searchsorted(index, piece_keys(0), "left")
        last = np.searchsorted(index, piece_keys((1 << bits) - 1), "right")
        # a counting sort by position; a position has one piece of each length at most
        longest_first = [np.flatnonzero((lengths == size) & (last > first))
                         for size in range(self.longest, 1, -1)]
        found = []
        for same in longest_first:
            count = last[same] - first[same]
            run = np.arange(count.sum()) + np.repeat(first[same] - (np.cumsum(count) - count), count)
            found.append((order[run], np.repeat(self.ranks[here][same], count)))
        starts = np.zeros(n + 1, dtype=np.int64)
        for position, _ in found:
            starts[position + 1] += 1        # no position twice in one pass
        np.cumsum(starts, out=starts)
        ranks, free = np.empty(starts[-1], dtype=np.int64), starts[:-1].copy()
        for position, r in found:
            ranks[free[position]] = r
            free[position] += 1
        return starts, ranks


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.matcher = SuffixMatcher(vocabulary)
        self.width = [len(p) for p in vocabulary.pieces]
        self.coded = [i.to_bytes(4, "little") for i in vocabulary.ids]
        self.known: dict[str, bytes] = {}       # the units of the present generation
        self.older: dict[str, bytes] = {}       # and of the one before
        self.agreed: dict[int, bool] = {}

    def agree(self, left: int, right: int) -> bool:
        """Whether BPE leaves these two pieces standing side by side."""
        pieces, rank, parts = self.v.pieces, self.v.rank, self.v.parts
        limit = 1 << 60
        while True:
            joined = rank.get(pieces[left] + pieces[right])
            if joined is not None and joined < limit:
                return False
            # undo the later of the two pieces' last merges; characters have none
            left_next, right_next = parts[left][1], parts[right][0]
            if left > right and left_next != left or right_next == right:
                if left_next == left:
                    return True
                limit, left = left, left_next
            else:
                limit, right = right + 1, right_next

    def relax(self, begin: int, text: str, starts: list[int], ranks: list[int]) -> bytes:
        """The ids of one unit, whose edges begin at ``starts[begin]``.

        From left to right the longest edge that agrees with the piece before it is
        taken; a position from which nothing agrees is not visited again.
        """
        agreed, widths, rank, size = self.agreed, self.width, self.v.rank, len(self.width)
        n, at, before = len(text), 0, -1
        path: list[int] = []          # ranks, or -1 for a character in no piece
        tried: list[int] = []         # the next edge to try at each position of the path
        dead = set()
        edge = starts[begin]
        while at < n:
            end = starts[begin + at + 1]
            while edge <= end:
                # after the longer pieces: the character alone
                r = ranks[edge] if edge < end else rank.get(text[at], -1)
                edge += 1
                if before >= 0 and r >= 0:
                    key = before * size + r
                    ok = agreed.get(key)
                    if ok is None:
                        ok = agreed[key] = self.agree(before, r)
                    if not ok:
                        continue
                to = at + (widths[r] if r >= 0 else 1)
                if to not in dead:
                    path.append(r)
                    tried.append(edge)
                    before, at = r, to
                    edge = starts[begin + at]
                    break
            else:
                dead.add(at)
                r = path.pop()
                at -= widths[r] if r >= 0 else 1
                edge = tried.pop()
                before = path[-1] if path else -1
        out, at = [], 0
        for r in path:
            out.append(self.coded[r] if r >= 0 else self.as_bytes(text[at]))
            at += widths[r] if r >= 0 else 1
        return b"".join(out)

    def as_bytes(self, char: str) -> bytes:
        return b"".join(self.v.byte_ids[b].to_bytes(4, "little") for b in char.encode("utf-8"))

    def learn(self, units: set[str]) -> None:
        """Have all ``units`` in ``known``; two generations bound what is remembered."""
        if len(self.known) + len(units) > KNOWN_UNITS:
            self.known, self.older = {}, self.known
        if len(self.agreed) > 2 * KNOWN_UNITS:
            self.agreed.clear()
        known, older, new = self.known, self.older, []
        for u in units - known.keys():
            if u in older:
                known[u] = older[u]
            else:
                new.append(u)
        if not new:
            return
        starts, ranks = self.matcher.edges("\x00".join(new))
        starts, ranks = starts.tolist(), ranks.tolist()
        at = 0
        for u in new:
            known[u] = self.relax(at, u, starts, ranks)
            at += len(u) + 1

    def forget(self) -> None:
        """Let go of what was learnt of texts; the vocabulary's own tables stay."""
        self.known, self.older, self.agreed = {}, {}, {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        split = [UNIT.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        self.learn(set(chain.from_iterable(split)))
        return [b"".join(map(self.known.__getitem__, s)) for s in split]


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        size = max([*vocabulary.ids, *vocabulary.byte_ids]) + 1
        self.table = [b""] * size
        for piece, i in zip(vocabulary.pieces, vocabulary.ids):
            self.table[i] = piece.replace(SPACE, " ").encode("utf-8")
        for b, i in enumerate(vocabulary.byte_ids):
            self.table[i] = bytes([b])

    def decode(self, ids: list[int]) -> str:
        whole = b"".join(map(self.table.__getitem__, ids))
        return whole.decode("utf-8", "replace").removeprefix(" ")


_ready: dict[str, tuple[Encoder, Decoder]] = {}      # kept while a Python worker lives


def tools(path: str, vocabulary: Vocabulary) -> tuple[Encoder, Decoder]:
    if path not in _ready:
        _ready[path] = Encoder(vocabulary), Decoder(vocabulary)
    return _ready[path]


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= SLICE_CHARS:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_chars, n_tokens, token_ids, round_trip: one row per document.

    ``round_trip``: decoding the ids gives the text ("▁" read as a space). The
    vocabulary is read on the driver; tasks receive its pieces (a few MB). Python
    workers outlive their tasks and wait beside those of other stages, so a task
    forgets its units when it ends.
    """
    vocabulary = Vocabulary.load(model)
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("n_tokens", pa.int64()),
                        ("token_ids", pa.list_(pa.int32())), ("round_trip", pa.bool_())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = tools(model, vocabulary)
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, TEXTS):
                    rows = batch.slice(at, TEXTS)
                    yield from answered(rows.column(0), rows.column(1).to_pylist(), encoder, decoder)
        finally:
            encoder.forget()

    def answered(keys: pa.Array, texts: list[str | None], encoder: Encoder,
                 decoder: Decoder) -> Iterator[pa.RecordBatch]:
        for begin, end in slices(texts):
            part = [t or "" for t in texts[begin:end]]
            coded = encoder.encode(part)
            sizes = np.array([len(c) // 4 for c in coded], dtype=np.int64)
            values = np.frombuffer(b"".join(coded), dtype="<i4")
            offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
            same = [decoder.decode(values[a:b].tolist()) == t.replace(SPACE, " ")
                    for t, a, b in zip(part, offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [keys.slice(begin, end - begin).cast(pa.int64()),
                 pa.array([len(t) for t in part], pa.int64()), pa.array(sizes),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)), pa.array(same, pa.bool_())],
                schema=schema)

    return docs.select("doc_id", "text").mapInArrow(
        work, "doc_id long, n_chars long, n_tokens long, token_ids array<int>, round_trip boolean")


def decode(ids: Column, model: str = MODEL) -> Column:
    """The text of each array of ids; null and empty arrays give the empty text."""
    vocabulary = Vocabulary.load(model)

    @F.pandas_udf("string")
    def texts(rows):
        decoder = tools(model, vocabulary)[1]
        return rows.map(lambda r: "" if r is None else decoder.decode(list(r)))

    return texts(F.coalesce(ids, F.array().cast("array<int>")))
