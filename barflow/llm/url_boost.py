"""URL filter: host and path rules, and boosted trees for the URLs no rule fits.

A rule is a host and a path prefix with a verdict. It fits a URL whose host is the
rule's or one of its subdomains and whose path starts with the rule's; of several
the longest wins. URLs that a rule judges are the labelled ones: gradient-boosted
trees learn from them, over lexical features alone, and judge the rest.

Features: length, path depth, digit ratio, character entropy, parameters, labels
and hyphens of the host, longest path part, fragment, and the smoothed block rates
of the host's last and last two labels. Suffixes are counted over all labelled URLs,
in SUFFIX_SLOTS hashed slots, so that the table that meets every URL stays bounded.
The trees are fitted on at most ``fit_rows`` labelled URLs, those with the smallest
hash; everything else covers all rows.

All of it is DataFrame expressions and Spark's own boosted trees.

Defined results: null URLs and URLs without ``://`` have empty host and path, fit no
rule and are judged by their features; without labelled URLs of both verdicts the
unjudged ones get the only verdict there is, else ``allow``; repeated rows are equal;
an empty table gives an empty result. Extra columns are kept.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import lower_ascii, unused

SUFFIX_SLOTS = 4096
PRIOR_ROWS = 20.0             # weight of the overall block rate in a suffix's rate


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule's text and verdict; null where none fits."""
    text = verdict = F.when(F.lit(False), F.lit(None).cast("string"))
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, verdict = text.when(fits, F.lit(r.text)), verdict.when(fits, F.lit(r.verdict))
    return text, verdict


def occurrences(text: Column, part: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))


def entropy(text: Column) -> Column:
    """Bits a character, in any case."""
    def of(low: Column) -> Column:
        n = F.length(low).cast("double")
        counts = F.transform(F.array_distinct(F.split(low, "")),
                             lambda c: F.length(low) - F.length(F.replace(low, c, F.lit(""))))
        weighted = F.aggregate(counts, F.lit(0.0), lambda total, c: total + F.when(
            c > 0, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0)))
        return F.when(n > 0, F.log2(n) - weighted / n).otherwise(F.lit(0.0))

    # as an array's one element the lower-cased text is worked out once
    return F.element_at(F.transform(F.array(lower_ascii(text)), of), 1)


def suffix_slot(host: Column, labels: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(labels), F.substring_index(host, ".", -labels)),
                  F.lit(SUFFIX_SLOTS)).cast("int")


LEXICAL = ("url_length", "depth", "digit_ratio", "char_entropy", "parameters", "host_labels",
           "host_hyphens", "longest_part", "has_fragment", "last_char_slash")
FEATURES = (*LEXICAL, "suffix_rate_1", "suffix_rate_2")


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    text = F.coalesce(url, F.lit(""))
    n = F.length(text).cast("double")
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    digits = F.length(text) - F.length(F.translate(text, "0123456789", ""))
    parts = F.transform(F.split(path, "/"), lambda p: F.length(p))
    return {
        "url_length": n,
        "depth": F.size(F.filter(parts, lambda p: p > 0)).cast("double"),
        "digit_ratio": digits / F.greatest(n, F.lit(1.0)),
        "char_entropy": entropy(text),
        "parameters": F.when(F.length(query) > 0, occurrences(query, "&") + 1).otherwise(0).cast("double"),
        "host_labels": F.when(F.length(host) > 0, occurrences(host, ".") + 1).otherwise(0).cast("double"),
        "host_hyphens": occurrences(host, "-").cast("double"),
        "longest_part": F.array_max(parts).cast("double"),
        "has_fragment": F.contains(text, F.lit("#")).cast("double"),
        "last_char_slash": path.endswith("/").cast("double"),
    }


def suffix_rates(labelled: DataFrame) -> dict[tuple[int, int], float]:
    """(labels, slot) -> smoothed block rate, over all labelled URLs.

    Summed before they move; at most 2 x SUFFIX_SLOTS rows reach the driver.
    """
    slots = F.array(*[F.struct(F.lit(i).alias("labels"), suffix_slot(F.col("host"), i).alias("slot"))
                      for i in (1, 2)])
    rows = (labelled.select(F.explode(slots).alias("s"), "blocked").groupBy("s")
            .agg(F.sum("blocked").alias("b"), F.count(F.lit(1)).alias("n")).collect())
    overall = sum(r.b for r in rows) / max(1, sum(r.n for r in rows))
    return {(r.s.labels, r.s.slot): (r.b + PRIOR_ROWS * overall) / (r.n + PRIOR_ROWS) for r in rows}


@dataclass
class Judge:
    trees: GBTClassificationModel | None
    rates: dict[tuple[int, int], float]
    base_rate: float
    verdict: str                 # where there are no trees


def rate_of(judge: Judge, host: Column, labels: int) -> Column:
    known = {slot: r for (n, slot), r in judge.rates.items() if n == labels}
    # one text literal, which the optimizer folds into one array
    text = json.dumps([known.get(s, judge.base_rate) for s in range(SUFFIX_SLOTS)])
    return F.element_at(F.from_json(F.lit(text), "array<double>"), suffix_slot(host, labels) + 1)


def fit(pages: DataFrame, rules: tuple[Rule, ...] = RULES, fit_rows: int = 20_000, trees: int = 20,
        depth: int = 4) -> Judge:
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    _, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    labelled = (pages.select("url").select("url", host.alias("host"), path.alias("path"))
                .withColumn("blocked", (verdict == "block").cast("double")).where("blocked is not null"))
    n, blocked, different = labelled.agg(F.count(F.lit(1)), F.sum("blocked"),
                                         F.approx_count_distinct("url")).first()
    if not n or blocked in (0, n):
        return Judge(None, {}, 0.0, "block" if n and blocked == n else "allow")
    judge = Judge(None, suffix_rates(labelled), blocked / n, "allow")
    # different URLs, each with its number of rows: a copied one takes one place. About twice
    # the rows wanted pass the cut by hash, and only these are grouped.
    place = F.pmod(F.xxhash64("url"), F.lit(1 << 30))
    sample = (labelled.where(place < int((1 << 30) * min(1.0, 2 * fit_rows / max(1, different))))
              .groupBy("url", "host", "path", "blocked").agg(F.count(F.lit(1)).cast("double").alias("copies"))
              .orderBy(F.xxhash64("url"), "url").limit(fit_rows))
    features = with_features(sample, judge)
    judge.trees = GBTClassifier(labelCol="blocked", featuresCol="features", maxIter=trees, maxDepth=depth,
                                stepSize=0.2, seed=11, weightCol="copies").fit(
        VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(features)
        .select("features", "blocked", "copies"))
    return judge


def with_features(df: DataFrame, judge: Judge) -> DataFrame:
    """``df`` with url, host and path, and the features beside them."""
    host = F.col("host")
    return df.withColumns({**lexical(F.col("url"), host, F.col("path")),
                           "suffix_rate_1": rate_of(judge, host, 1),
                           "suffix_rate_2": rate_of(judge, host, 2)})


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, **how) -> DataFrame:
    """``pages`` with host, path, rule, block_score and verdict (names made free if taken)."""
    judge = fit(pages, rules, **how)
    host, path, rule, score, verdict, row = unused(
        pages, "host", "path", "rule", "block_score", "verdict", "_row")
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias(row),
                        F.col("url").alias("url"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    text, stated = fitting_rule(F.col("host"), F.col("path"), rules)
    if judge.trees is None:
        p = F.lit(1.0 if judge.verdict == "block" else 0.0)
        judged = rows
    else:
        judged = judge.trees.transform(VectorAssembler(
            inputCols=list(FEATURES), outputCol="features").transform(with_features(rows, judge)))
        p = vector_to_array("probability")[1]
    guess = F.when(p >= 0.5, "block").otherwise("allow")
    return judged.select(*[F.col(row)[c].alias(c) for c in pages.columns], F.col("host").alias(host),
                         F.col("path").alias(path), text.alias(rule), p.alias(score),
                         F.coalesce(stated, guess).alias(verdict))
