"""Personal data: fixed patterns, and boosted trees over high-recall candidates.

Patterns (email, ip, card, phone) give the base spans: leftmost matches, failing
ones dropped. Generators then propose loose spans that may overlap: spelled-out or
spaced addresses, digit groups with any separators, dotted numbers, account codes.
Each candidate has features of its format (lengths, groups, separators, checksum)
and of its context (characters around it, telling words before it).

Trees learn on the candidates of all documents. What the base patterns cover
teaches nothing by itself: each base span is rewritten, where it stands, into loose
forms that the patterns miss (LOOSE: spelled-out and spaced addresses, other
separators, no plus sign, a bank account number for a card number), which are personal
data, and into listed forms that look alike and are none (ALIKE). Candidates that no
base span covers are no personal data either, unless their loose reading holds
(``may_be``: a checksum, an address, a telephone number's groups); those have no label.
No feature tells of a plain @ or a leading plus sign. The labelled candidates are
written once. One half by document, by a hash of id and text, fits the trees; the other
sets each kind's threshold: half way below the lowest score down to which the share of
true candidates stays at ``precision``, and one half at least. It is read off the counts
by score, where scores that agree in ``SCORE_BINS`` parts stand or fall together. Candidates that reach their
threshold and overlap no base span and no better candidate are added as spans of
kind ``like_<kind>``. Base spans always stay.

The learner is Spark's; tasks receive the fitted trees as plain arrays.

Defined results: null texts count as empty and have no spans; with too few labelled
candidates nothing is added; repeated rows get equal results; an empty table gives
an empty result. Spans count code points, end exclusive. Extra columns are kept.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.llm.common import Scratch

# The base patterns. No match of ip can start inside a run of digits,
# and none of email inside a run of its first characters; stating so keeps long
# runs linear.
EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
EMAIL_HEAD = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone")
LIKE = tuple(f"like_{k}" for k in KINDS)
ANCHOR = re.compile(r"[0-9@]|[\[(]\x20?at\x20?[\])]")     # no span, base or proposed, is without

# Words that tell of personal data, by kind.
TELLING = {
    "email": ("mail", "contact", "write", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "addr"),
    "card": ("card", "visa", "account", "iban", "tarjeta", "carte", "karte"),
    "phone": ("tel", "phone", "call", "fax", "mobile", "cell"),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in the order of start, then of KINDS."""
    out = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in EMAIL_HEAD:
            start -= 1
        tail = EMAIL_TAIL.match(text, at) if start < at else None
        if tail:
            out.append((start, tail.end(), "email"))
        done = tail.end() if tail else at + 1
        at = text.find("@", done)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        d = digits_of(m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(digits_of(m[0])) <= 15:
                out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


class Cover:
    """Disjoint stretches of a text; asks and additions take a binary search."""

    def __init__(self, spans=()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def hits(self, start: int, end: int) -> bool:
        i = bisect(self.starts, start)
        return (i > 0 and self.ends[i - 1] > start) or (i < len(self.starts) and self.starts[i] < end)

    def add(self, start: int, end: int) -> None:
        """A stretch that hits no other."""
        i = bisect(self.starts, start)
        self.starts.insert(i, start)
        self.ends.insert(i, end)


# ------------------------------------------------------------ candidates
# High-recall generators; each part is bounded, so a match costs a bounded search.
GENERATORS = (
    ("email", re.compile(r"[\w.%+-]{1,64}\x20?(?:@|[\[(]\x20?at\x20?[\])])\x20?[\w-]{1,63}"
                         r"(?:\x20?(?:\.|[\[(]\x20?dot\x20?[\])])\x20?[\w-]{1,63}){1,5}")),
    ("ip", re.compile(r"(?<![\w.])[0-9]{1,4}(?:\x20?\.\x20?[0-9]{1,4}){3}(?![\w])")),
    ("card", re.compile(r"(?<![\w])(?:[0-9]{2,7}[\x20./_-]{1,2}){2,6}[0-9]{2,7}(?![\w])|(?<![\w])[0-9]{12,19}(?![\w])"
                        r"|(?<![\w])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![\w])")),
    ("phone", re.compile(r"(?<![\w])\+?\(?[0-9]{1,4}\)?(?:[\x20./-]{0,2}\(?[0-9]{2,5}\)?){2,5}(?![\w])")),
)
FEATURES = 22
ROWS_AT_ONCE = 5_000            # labelled candidates that a task hands on together
SCORE_BINS = 1 << 16            # parts of the range of scores that are told apart


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind index) of every generator's matches."""
    return [(m.start(), m.end(), k) for k, (_, pattern) in enumerate(GENERATORS)
            for m in pattern.finditer(text)]


def char_class(c: str) -> float:
    return 0.0 if not c else 1.0 if c.isspace() else 2.0 if c.isalpha() else 3.0 if c.isdigit() else 4.0


def features(text: str, start: int, end: int, kind: int) -> list[float]:
    s = text[start:end]
    d = digits_of(s)
    groups = re.findall(r"[0-9]+", s)
    letters = sum(map(str.isalpha, s))
    before = text[max(0, start - 32):start].lower()
    values = [int(g) for g in groups if len(g) <= 4]
    return [
        float(kind), float(len(s)), float(len(d)), len(d) / len(s), float(letters), float(len(groups)),
        float(len(groups[0])) if groups else 0.0, float(len(groups[-1])) if groups else 0.0,
        float(max(map(len, groups), default=0)), float(min(map(len, groups), default=0)),
        float(s.count(".")), float(s.count("-")), float(s.count(" ")), float(s.count("/") + s.count("_")),
        float(s[-1].isalpha()), float("(" in s), float(iban_holds(s) or (len(d) >= 12 and not letters and luhn(d))),
        float(max(values, default=0)),
        float(len(set(d))), char_class(text[start - 1:start]), char_class(text[end:end + 1]),
        float(any(w in before for w in TELLING[KINDS[kind]])),
    ]


# ------------------------------------------------------------ loose and similar forms
def iban(country: str, body: str) -> str:
    """A bank account number with its check digits."""
    return f"{country}{98 - remainder(body + country + '00'):02d}{body}"


def remainder(code: str) -> int:
    return int("".join(str(int(c, 36)) for c in code)) % 97


def iban_holds(s: str) -> bool:
    code = s.replace(" ", "")
    return bool(re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{10,30}", code)) and remainder(code[4:] + code[:4]) == 1


def grouped(d: str, sizes: tuple[int, ...], sep: str) -> str:
    out, at = [], 0
    for n in sizes:
        out.append(d[at:at + n])
        at += n
    return sep.join(x for x in [*out, d[at:]] if x)


def last_digit(d: str, right: bool) -> str:
    """``d`` with its last digit such that the checksum holds or not."""
    return next(d[:-1] + c for c in "0123456789" if luhn(d[:-1] + c) == right)


# Forms of a base span that no base pattern covers, by kind.
LOOSE = {
    "email": (lambda s, d: s.replace("@", " (at) ").replace(".", " (dot) "), lambda s, d: s.replace("@", "(at)"),
              lambda s, d: s.replace("@", " [at] "), lambda s, d: s.replace("@", "[at]"), lambda s, d: s.replace("@", "[at]").replace(".", "[dot]"),
              lambda s, d: s.replace("@", " @ ")),
    "ip": (lambda s, d: s.replace(".", " . "), lambda s, d: s.replace(".", ". "), lambda s, d: s.replace(".", " .")),
    "card": (lambda s, d: grouped(d, (4, 4, 4), "."), lambda s, d: grouped(d, (4, 4, 4), "_"),
             lambda s, d: grouped(d, (4, 4, 4), "/"), lambda s, d: grouped(d, (4, 4, 4), "  "),
             lambda s, d: iban("DE", (d * 2)[:18]), lambda s, d: grouped(iban("GB", "WEST" + (d * 2)[:14]), (4,) * 5, " ")),
    "phone": (lambda s, d: s[1:], lambda s, d: "(" + grouped(d[-10:-7], (3,), "") + ") " + grouped(d[-7:], (3,), "-"),
              lambda s, d: grouped(d[-10:], (3, 3), "-"), lambda s, d: grouped(d[-10:], (3, 3), "."),
              lambda s, d: grouped(d[-10:], (3, 3), " ")),
}
# Fixed values, checked by hand: forms that the generators propose and that are no personal data.
ALIKE = {
    "email": (lambda s, d: f"{len(s)} @ {len(s) % 9}.50", lambda s, d: f"table (at) {len(s)}.30",
              lambda s, d: f"build @ 1.{len(s)}.0", lambda s, d: f"rate[at]{len(s)}.5"),
    "ip": (lambda s, d: " . ".join(f"{300 + len(d) * i}" for i in range(4)),
           lambda s, d: f"2024. {1 + len(d)}. 12. 7000", lambda s, d: f"{len(d)} .{900 + len(d)} .7 .1"),
    "card": (lambda s, d: grouped(last_digit(d, False), (4, 4, 4), "."),
             lambda s, d: grouped(last_digit(d, False), (4, 4, 4), "/"),
             lambda s, d: f"2024/{d[:2]}/{d[2:4]}/{d[4:8]}", lambda s, d: last_digit(d, False),
             lambda s, d: "DE00" + (d * 2)[:18], lambda s, d: grouped("AB00" + (d * 2)[:16], (4,) * 4, " "),
             lambda s, d: f"{d[:3]}-{d[3]}-{d[4:6]}-{d[6:12]}-00"),
    "phone": (lambda s, d: f"2024-{d[:2]}-{d[2:4]} {d[4:6]}.{d[6:8]}", lambda s, d: grouped(d[:12], (4, 4), " "),
              lambda s, d: f"12.05.2024 {d[:2]}.30", lambda s, d: f"1990-{d[:4]}-2000", lambda s, d: grouped(d[:9], (3, 3), " "),
              lambda s, d: f"3.{d[:4]} {d[4:9]}"),
}
CARD_SIGNS = re.compile(r"[\x20./_-]")


def may_be(s: str, kind: int) -> bool:
    """Whether the loose reading of a candidate holds, so that it may be personal data."""
    d = digits_of(s)
    if KINDS[kind] == "email":
        plain = re.sub(r"\x20?[\[(]\x20?at\x20?[\])]\x20?|\x20?@\x20?", "@", s)
        plain = re.sub(r"\x20?[\[(]\x20?dot\x20?[\])]\x20?|\x20?\.\x20?", ".", plain)
        return plain[-1:].isalpha() and any(k == "email" for _, _, k in base_spans(plain))
    if KINDS[kind] == "ip":
        return any(k == "ip" for _, _, k in base_spans(s.replace(" ", "")))
    if KINDS[kind] == "card":
        return iban_holds(s) or (12 <= len(d) <= 19 and luhn(d) and CARD_SIGNS.sub("", s) == d)
    return tuple(map(len, re.findall(r"[0-9]+", s))) in ((3, 3, 4), (1, 3, 3, 4))


def labelled(text: str) -> list[tuple[int, int, list[float]]]:
    """(start, label, features) of a text's candidates and of its rewritten base spans."""
    spans = base_spans(text)
    base, out = Cover((s, e) for s, e, _ in spans), []
    for start, end, kind in candidates(text):
        if not base.hits(start, end) and not may_be(text[start:end], kind):
            out.append((start, 0, features(text, start, end, kind)))
    for start, end, name in spans:
        s, before, after = text[start:end], text[max(0, start - 64):start], text[end:end + 64]
        for true, forms in ((1, LOOSE[name]), (0, ALIKE[name])):
            for form in forms:
                new = form(s, digits_of(s))
                at, to = len(before), len(before) + len(new)
                around = before + new + after
                if true and any(a < to and b > at for a, b, _ in base_spans(around)):
                    continue      # a base span again
                for a, b, kind in candidates(around):
                    if a >= to or b <= at:
                        continue
                    if true and KINDS[kind] == name:
                        if a <= at and b >= to:
                            out.append((start, 1, features(around, a, b, kind)))
                    elif true or not may_be(around[a:b], kind):       # of another kind, or of none
                        out.append((start, 0, features(around, a, b, kind)))
    return out


# ------------------------------------------------------------ trees
@dataclass
class Trees:
    """Boosted trees as lists of nodes (feature, bound, left, right, value)."""

    trees: list[tuple[float, list[tuple[int, float, int, int, float]]]] = field(default_factory=list)
    bars: tuple[float, ...] = (np.inf,) * len(KINDS)

    def score(self, x: list[float]) -> float:
        total = 0.0
        for weight, nodes in self.trees:
            i = 0
            while nodes[i][0] >= 0:
                i = nodes[i][2] if x[nodes[i][0]] <= nodes[i][1] else nodes[i][3]
            total += weight * nodes[i][4]
        return float(1 / (1 + np.exp(-2 * np.clip(total, -50, 50))))


def as_lists(model) -> list[tuple[float, list]]:
    def walk(node, out: list) -> int:
        at = len(out)
        out.append(None)
        if node.subtreeDepth() == 0:
            out[at] = (-1, 0.0, -1, -1, float(node.prediction()))
        else:
            left, right = walk(node.leftChild(), out), walk(node.rightChild(), out)
            out[at] = (int(node.split().featureIndex()), float(node.split().threshold()), left, right, 0.0)
        return at

    out = []
    for weight, tree in zip(model.treeWeights, model.trees):
        nodes: list = []
        walk(tree._java_obj.rootNode(), nodes)
        out.append((float(weight), nodes))
    return out


def threshold(scores: np.ndarray, true: np.ndarray, precision: float, least: int = 20) -> float:
    """The lowest score down to which the share of true rows stays at ``precision``."""
    order = np.argsort(-scores, kind="stable")
    s, t = scores[order], true[order]
    share = np.cumsum(t) / np.arange(1, len(t) + 1)
    last = np.r_[s[1:] != s[:-1], True] if len(s) else np.empty(0, bool)      # ties stand or fall together
    good = np.flatnonzero(last & (share >= precision) & (np.arange(1, len(t) + 1) >= least))
    return float(s[good[-1]]) if len(good) else float("inf")


def bar(bins: pd.DataFrame, precision: float, least: int = 20) -> float:
    """Half way from the ``threshold`` to the next lower score, and one half at least, from
    the rows ``n``, the true ones ``t`` and the ``lowest`` and ``highest`` score of each bin."""
    bins = bins.sort_values("lowest", ascending=False)
    n, t = bins["n"].cumsum().to_numpy(), bins["t"].cumsum().to_numpy()
    good = np.flatnonzero((t >= precision * n) & (n >= least))
    if not len(good):
        return float("inf")
    below = bins["highest"].to_numpy()[good[-1] + 1:]
    return max(0.5, float(bins["lowest"].iloc[good[-1]] + (below[0] if len(below) else 0.0)) / 2)


def candidate_rows(docs: DataFrame) -> DataFrame:
    """(place, start, true, x) of all labelled candidates, those of repeated rows once."""
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))

    def drawn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = []
        for batch in batches:
            for text, where in zip(batch["text"], batch["place"]):
                rows += [(where, start, true, x) for start, true, x in labelled(text)]
                if len(rows) >= ROWS_AT_ONCE:
                    yield pd.DataFrame(rows, columns=["place", "start", "true", "x"])
                    rows = []
        yield pd.DataFrame(rows, columns=["place", "start", "true", "x"])

    return (docs.select("text", place.alias("place")).where(F.col("text").rlike(ANCHOR.pattern))
            .mapInPandas(drawn, "place long, start long, true int, x array<double>").distinct())


def score_bins(held: DataFrame, trees: Trees) -> pd.DataFrame:
    """By kind and score bin: rows, true ones, lowest and highest score; at most so many
    rows as there are kinds and bins."""
    @F.pandas_udf(T.DoubleType())
    def score(x: pd.Series) -> pd.Series:
        return pd.Series([trees.score(r.tolist()) for r in x], dtype=float)

    return (held.select("true", F.col("x")[0].cast("int").alias("kind"), score("x").alias("score"))
            .groupBy("kind", F.floor(F.col("score") * SCORE_BINS).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("true").alias("t"),
                 F.min("score").alias("lowest"), F.max("score").alias("highest")).toPandas())


def fit(docs: DataFrame, fit_rows: int | None = None, precision: float = 0.98,
        trees: int = 20, depth: int = 4) -> Trees:
    """Trees and thresholds from the candidates of all documents; ``fit_rows`` is for trials
    with no more than so many of them."""
    scratch = Scratch(docs.sparkSession, "pii_candidates")
    rows = candidate_rows(docs)
    if fit_rows is not None:
        rows = rows.orderBy(F.xxhash64("place", "start"), "place", "start", "x").limit(fit_rows)
    kept = scratch.cut(rows)
    half = {r.half: r for r in kept.groupBy((F.col("place") % 2).alias("half")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("true").alias("labels")).collect()}
    if 0 not in half or half[0].n < 40 or half[0].labels < 2 or 1 not in half or half[1].n < 40:
        scratch.drop(kept)
        return Trees()
    learn, held = (kept.where(F.col("place") % 2 == h) for h in (0, 1))
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, seed=5).fit(
        learn.select(F.col("true").cast("double").alias("label"), array_to_vector("x").alias("features")))
    made = Trees(as_lists(model))
    bins = score_bins(held, made)
    made.bars = tuple(bar(bins[bins["kind"] == k], precision) for k in range(len(KINDS)))
    scratch.drop(kept)
    return made


# ------------------------------------------------------------ operator
def all_spans(text: str | None, trees: Trees) -> list[tuple[int, int, str]]:
    """Base spans, then those the trees add."""
    if not text or not ANCHOR.search(text):
        return []
    base, added = base_spans(text), []
    if min(trees.bars) < np.inf:
        cover, scored = Cover((s, e) for s, e, _ in base), []
        for start, end, kind in candidates(text):
            if trees.bars[kind] < np.inf and not cover.hits(start, end):
                p = trees.score(features(text, start, end, kind))
                if p >= trees.bars[kind]:
                    scored.append((-p, start, end, kind))
        for _, start, end, kind in sorted(scored):
            if not cover.hits(start, end):
                cover.add(start, end)
                added.append((start, end, LIKE[kind]))
    return base + sorted(added)


SPAN = "array<struct<start:int,end:int,kind:string>>"


def find_spans(text: Column, trees: Trees) -> Column:
    @F.pandas_udf(SPAN)
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"start": s, "end": e, "kind": k} for s, e, k in all_spans(t, trees)]
                          for t in texts], dtype=object)

    return spans(text)


def redact(text: Column, trees: Trees) -> Column:
    """The text with each span replaced by its kind in brackets; null stays null."""
    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        def one(t):
            if t is None:
                return None
            out, at = [], 0
            for s, e, k in sorted(all_spans(t, trees)):
                if s >= at:
                    out += [t[at:s], f"[{k.upper()}]"]
                at = max(at, e)
            return "".join(out) + t[at:]
        return texts.map(one)

    return masked(text)
