"""Secret scan: fixed patterns, and a randomness test battery over other strings.

Patterns (kinds ``assign``, ``access``, ``hex``) give the base spans. The method
adds spans of kind ``random``: unbroken runs of encoding characters that

1. pass a battery of tests for uniform randomness over the alphabet of their
   inferred encoding: Pearson's chi-squared over the alphabet, the runs test
   about the alphabet's middle, and the lag-1 serial correlation, joined by
   Fisher's method; and
2. are told apart from ordinary words. Under ordinary text the chi-squared
   statistic has a non-centrality that grows with the length (``TEXT_REPEAT`` is
   the chance that two letters of ordinary text agree, or twice the uniform
   chance in a small alphabet), so the lower tail of
   that distribution is a p-value that takes the length into account. The
   p-values are held to a false-discovery rate over the whole corpus by the
   Benjamini-Hochberg step-up rule within each length class; p-values are
   counted in fixed bins, so that a bounded histogram, and no sort, decides.

All of it is DataFrame expressions. Spans count code points, end exclusive.

Defined results: null texts count as empty and have no spans; repeated rows get
equal results; an empty table gives an empty result; columns other than doc_id
and text are not read by ``find_spans`` and are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import unused

# The base patterns, in the order of their kinds, and the least
# length of the characters that each must have (of group 2 for assign).
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

# Alphabets of the inferred encodings, narrowest first.
ENCODINGS = (
    ("decimal", "0123456789"),
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("lower36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
TEXT_REPEAT = 0.075       # chance that two letters of ordinary text agree
BIN = 0.25                # width of a bin of -log10 p
BINS = 80                 # bins; the last takes all smaller p-values
LENGTH_CLASSES = 12       # doublings of the least length


# ------------------------------------------------------------ spans
def spans_of(text: Column, pattern: str, kind: str, keep=None) -> Column:
    """array<struct<start, end, kind, value>> of the leftmost matches of ``pattern``.

    The pieces between matches and the matches themselves, laid end to end, give
    each match's place. Texts without a match are not split.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
    parts = F.arrays_zip(gaps.alias("gap"), found.alias("value"))
    none = F.array().cast("array<struct<start:int,end:int,kind:string,value:string>>")
    walked = F.aggregate(
        parts, F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda acc, p: F.struct(
            (acc["at"] + p["gap"] + F.coalesce(F.length(p["value"]), F.lit(0))).alias("at"),
            F.when(p["value"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + p["gap"]).alias("start"),
                (acc["at"] + p["gap"] + F.length(p["value"])).alias("end"),
                F.lit(kind).alias("kind"), p["value"].alias("value"))))).alias("out")))["out"]
    spans = F.when(F.size(found) > 0, walked).otherwise(none)
    return F.filter(spans, keep) if keep is not None else spans


def base_spans(text: Column) -> Column:
    # Runs shorter than the least length never hold a longer one, so the bound may
    # stand in the patterns of access and hex; assign's value is measured afterwards.
    long_value = lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= MIN_ASSIGN
    return F.concat(
        spans_of(text, ASSIGN, "assign", long_value),
        spans_of(text, ACCESS.replace("+", f"{{{MIN_ACCESS - 4},}}"), "access"),
        spans_of(text, HEX.replace("+", f"{{{MIN_HEX},}}"), "hex"))


KINDS = ("assign", "access", "hex", "random")


# ------------------------------------------------------------ battery
def upper_normal(z: Column) -> Column:
    """P(Z > z): Abramowitz and Stegun 7.1.26 with its exponential factor."""
    x = F.abs(z) / F.lit(2 ** 0.5)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (
        -1.453152027 + t * 1.061405429))))
    tail = poly * F.exp(-x * x) / 2
    return F.when(z >= 0, tail).otherwise(1 - tail)


def log10_upper_normal(z: Column) -> Column:
    """-log10 P(Z > z) for any z: the tail's expansion where the value itself is tiny."""
    far = (z * z / 2 + F.log(z) + F.lit(0.9189385332046727)) / F.lit(2.302585092994046)
    return F.when(z > 5, far).otherwise(-F.log10(F.greatest(upper_normal(z), F.lit(1e-300))))


def wilson_hilferty(x: Column, df: Column) -> Column:
    """The normal score of a chi-squared value."""
    v = 2 / (9 * df)
    return (F.pow(x / df, F.lit(1 / 3)) - (1 - v)) / F.sqrt(v)


def battery(value: Column) -> Column:
    """struct<encoding, n, p_random, evidence> of a run of characters.

    ``p_random``: p-value of uniform randomness (Fisher over the three tests).
    ``evidence``: -log10 of the p-value of ordinary text.
    """
    encoding = F.when(F.lit(False), F.lit(None).cast("string"))
    alphabet = F.when(F.lit(False), F.lit(None).cast("string"))
    body = F.regexp_replace(value, "=+$", "")
    for name, chars in ENCODINGS:
        only = F.length(F.translate(body, chars, "")) == 0
        encoding, alphabet = encoding.when(only, F.lit(name)), alphabet.when(only, F.lit(chars))
    spec = F.struct(encoding.alias("encoding"), alphabet.alias("alphabet"), body.alias("body"))

    def measured(s: Column) -> Column:
        n = F.length(s["body"]).cast("double")
        size = F.length(s["alphabet"]).cast("double")
        counts = F.transform(F.split(s["alphabet"], ""), lambda c: F.length(s["body"]) - F.length(
            F.replace(s["body"], c, F.lit(""))))
        squares = F.aggregate(counts, F.lit(0.0), lambda a, c: a + c.cast("double") * c)
        codes = F.transform(F.split(s["body"], ""), lambda c: F.instr(s["alphabet"], c))
        return F.struct(s["encoding"].alias("encoding"), n.alias("n"), size.alias("size"),
                        squares.alias("squares"), codes.alias("codes"))

    def serial(m: Column) -> Column:
        """Sums over neighbours: runs, products, and single sums of the centred codes."""
        mid = (m["size"] + 1) / 2
        zero = F.lit(0.0)
        return F.aggregate(
            m["codes"],
            F.struct(F.lit(None).cast("double").alias("prev"), zero.alias("runs"), zero.alias("high"),
                     zero.alias("cross"), zero.alias("sum"), zero.alias("squares")),
            lambda a, c: F.struct(
                (c - mid).alias("prev"),
                (a["runs"] + F.when(a["prev"].isNull() | ((a["prev"] > 0) != (c > mid)), 1.0)
                 .otherwise(0.0)).alias("runs"),
                (a["high"] + F.when(c > mid, 1.0).otherwise(0.0)).alias("high"),
                (a["cross"] + F.coalesce(a["prev"] * (c - mid), zero)).alias("cross"),
                (a["sum"] + (c - mid)).alias("sum"),
                (a["squares"] + (c - mid) * (c - mid)).alias("squares")))

    def tested(m: Column, w: Column) -> Column:
        n, size = m["n"], m["size"]
        chi = size * m["squares"] / n - n
        p_chi = upper_normal(wilson_hilferty(F.greatest(chi, F.lit(1e-9)), size - 1))
        low, high = n - w["high"], w["high"]
        mean_runs = 1 + 2 * low * high / n
        var_runs = (mean_runs - 1) * (mean_runs - 2) / F.greatest(n - 1, F.lit(1.0))
        z_runs = F.when(var_runs > 0, (w["runs"] - mean_runs) / F.sqrt(var_runs)).otherwise(F.lit(9.0))
        p_runs = 2 * upper_normal(F.abs(z_runs))
        var_all = n * (size * size - 1) / 12
        z_serial = w["cross"] / var_all * F.sqrt(n)
        p_serial = 2 * upper_normal(F.abs(z_serial))
        tiny = F.lit(1e-30)
        fisher = -2 * (F.log(F.greatest(p_chi, tiny)) + F.log(F.greatest(p_runs, tiny))
                       + F.log(F.greatest(p_serial, tiny)))
        half = fisher / 2          # chi-squared with 6 degrees of freedom, upper tail
        p_random = F.exp(-half) * (1 + half + half * half / 2)
        extra = n * F.greatest(size * F.lit(TEXT_REPEAT) - 1, F.lit(1.0))
        df = size - 1
        z_text = (df + extra - chi) / F.sqrt(2 * (df + 2 * extra))
        evidence = F.greatest(log10_upper_normal(z_text), F.lit(0.0))
        return F.struct(m["encoding"].alias("encoding"), n.cast("int").alias("n"),
                        p_random.alias("p_random"), evidence.alias("evidence"))

    def one(x: Column, f):
        """Name an intermediate value once, so that it is worked out once."""
        return F.element_at(F.transform(F.array(x), f), 1)

    known = one(spec, lambda s: F.when(s["encoding"].isNotNull(), one(
        measured(s), lambda m: one(serial(m), lambda w: tested(m, w)))))
    return known


def candidates(text: Column, min_length: int) -> Column:
    """Runs of encoding characters of at least ``min_length`` with a digit in them, tested.

    Words without a digit are no candidates: an alphabetic word is a word.
    """
    run = rf"[A-Za-z0-9+/_-]{{{min_length},}}={{0,2}}"
    spans = spans_of(text, run, "random", lambda s: s["value"].rlike("[0-9]"))
    scored = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"),
        battery(s["value"]).alias("tests")))
    return F.filter(scored, lambda s: s["tests"].isNotNull())


def length_class(n: Column, min_length: int) -> Column:
    return F.least(F.floor(F.log2(n / F.lit(float(min_length)))), F.lit(LENGTH_CLASSES - 1)).cast("int")


def evidence_bin(evidence: Column) -> Column:
    return F.least(F.floor(evidence / BIN), F.lit(BINS - 1)).cast("int")


def discovery_bins(tests: DataFrame, min_length: int, rate: float) -> list[int]:
    """For each length class, the least bin of evidence that keeps the false-discovery rate.

    ``tests`` has ``n`` and ``evidence``. The histogram has at most
    LENGTH_CLASSES x BINS rows. A class without discoveries gets BINS.
    """
    rows = (tests.select(length_class(F.col("n"), min_length).alias("c"),
                         evidence_bin(F.col("evidence")).alias("b"))
            .groupBy("c", "b").agg(F.count(F.lit(1)).alias("n")).collect())
    bars = []
    for c in range(LENGTH_CLASSES):
        bins = sorted(((r.b, r.n) for r in rows if r.c == c), reverse=True)
        total, at_least, bar = sum(n for _, n in bins), 0, BINS
        for b, n in bins:
            at_least += n
            if total * 10 ** (-b * BIN) <= rate * at_least:   # the bin's largest p-value
                bar = b
        bars.append(bar)
    return bars


# ------------------------------------------------------------ operator
def find_spans(docs: DataFrame, into: str, min_length: int = 20, rate: float = 0.01,
               alpha: float = 0.001) -> DataFrame:
    """``docs`` with column ``into``: struct<base, added> of span arrays.

    ``min_length``: least length of a tested run; ``rate``: false-discovery rate;
    ``alpha``: p-value below which a run is no random string. One pass counts the
    corpus's p-values, a second one, without a shuffle, decides each document's.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    tests = docs.select(F.explode(candidates(text, min_length)).alias("s")).select("s.tests.*")
    bars = F.array(*map(F.lit, discovery_bins(tests, min_length, rate)))
    tried, base = unused(docs, "_tried", "_base")
    passed = F.filter(tried, lambda s: (s["tests"]["p_random"] >= alpha) & (
        evidence_bin(s["tests"]["evidence"])
        >= F.element_at(bars, length_class(s["tests"]["n"], min_length) + 1)))
    clear = F.filter(passed, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"])
                                                & (s["start"] < b["end"])))
    added = F.transform(clear, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"),
        F.lit(None).cast("string").alias("value")))
    return (docs.withColumns({tried: candidates(text, min_length), base: base_spans(text)})
            .withColumn(into, F.struct(F.col(base).alias("base"), added.alias("added")))
            .drop(tried, base))


def merged(spans: Column) -> Column:
    """Spans joined where they overlap or touch, by start: array<struct<start, end>>."""
    none = F.array().cast("array<struct<start:int,end:int>>")
    return F.aggregate(
        F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"),
                                                           s["end"].alias("end")))), none,
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (s["start"] <= F.element_at(acc, -1)["end"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["start"].alias("start"),
                F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(s))))


def redact(docs: DataFrame, mask: str = "[SECRET]", **how) -> DataFrame:
    """``docs`` with every span replaced by ``mask``; all rows and columns stay.

    Null texts stay null. n_chars, where there, follows the new text.
    """
    found, cover = unused(docs, "_found", "_cover")
    rows = find_spans(docs, found, **how).withColumn(
        cover, merged(F.concat(F.col(found)["base"], F.col(found)["added"])))
    cut = F.aggregate(
        F.col(cover), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, x: F.struct(x["end"].alias("at"), F.concat(
            acc["out"], F.substring(F.col("text"), acc["at"] + 1, x["start"] - acc["at"]),
            F.lit(mask)).alias("out")),
        lambda acc: F.concat(acc["out"], F.substring(
            F.col("text"), acc["at"] + 1, F.length("text"))))
    rows = rows.withColumn("text", F.when(F.size(cover) == 0, F.col("text")).otherwise(cut))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.size(cover) == 0, F.col("n_chars"))
                               .otherwise(F.length("text").cast("long")))
    return rows.select(*docs.columns)
