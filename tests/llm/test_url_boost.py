import random

from pyspark.sql import functions as F

from barflow.llm.url_boost import RULES, entropy, judge_urls
from tests.llm.samples import SF_SMALL, with_clashes


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        i = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:i])
        tail = rest[i:]
        path = tail[:min([tail.index(c) for c in "?#" if c in tail] or [len(tail)])]
    best = None
    for r in RULES:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path):
            if best is None or len(r.text) > len(best.text):
                best = r
    return host, path, best.text if best else None, best.verdict if best else None


URLS = [None, "", "no scheme", "http://", "http://A.Example.COM/en/x?y://z", "http://www.example.com/en/",
        "http://www.example.com/en", "https://x.www.example.com/en/1#f", "https://net/es/", "https://a.net?x/es/",
        "ftp://anet/es/", "http://b.net/fr/a", "http://b.net/frx/", "http://com/", "http://com", "a://b://c.com/",
        "http://É.com/", "http://example.com//en/", "http://h\n.com/x", "://q.net/es/"]


def test_rules_match_a_plain_reading(spark):
    rng = random.Random(1)
    urls = URLS + [f"http://{rng.choice(['www.', '', 'm.'])}{rng.choice(['example.com', 'a.net', 'b.org'])}"
                   f"/{rng.choice(['en', 'es', 'fr', 'de'])}/{rng.randrange(99)}" for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = judge_urls(df).collect()
    assert len(rows) == len(urls)
    for r in rows:
        host, path, rule, verdict = plain(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")


def test_trees_learn_what_the_features_tell(spark):
    rng = random.Random(2)
    rows = []
    for i in range(900):
        bad = i % 2
        tail = "".join(rng.choice("0123456789" if bad else "abcdefgh") for _ in range(20))
        # both verdicts share suffixes and lengths, so that only the digits tell them apart
        rows.append((i, f"http://{'abc' if bad else 'www'}.example.com/en/{tail}"))
    rows += [(1000 + i, f"http://q.example.org/de/" + ("".join(rng.choice("0123456789") for _ in range(20))
                                               if i % 2 else "".join(rng.choice("abcdefgh") for _ in range(20))))
             for i in range(100)]
    got = judge_urls(spark.createDataFrame(rows, "page_id long, url string")).where("page_id >= 1000").collect()
    right = sum((r.verdict == "block") == bool(r.page_id % 2) for r in got)
    assert right >= 90


def test_entropy(spark):
    df = spark.createDataFrame([("",), ("aaaa",), ("abab",), ("AbaB",), ("abcd",)], "t string")
    assert [round(r[0], 6) for r in df.select(entropy(F.col("t"))).collect()] == [0, 0, 1, 1, 2]


def test_pages_and_odd_tables(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    out = judge_urls(pages)
    assert out.count() == pages.count() and out.where("verdict is null").count() == 0
    clash = with_clashes(pages.select("page_id", "url").limit(20))
    assert judge_urls(clash).columns[:len(clash.columns)] == clash.columns
    assert judge_urls(pages.where(F.lit(False))).count() == 0
    only = spark.createDataFrame([(1, "http://a.net/es/x"), (2, "http://b.org/")], "page_id long, url string")
    assert [r.verdict for r in judge_urls(only).collect()] == ["block", "block"]


def test_a_copied_url_does_not_fill_the_sample(spark):
    hot = spark.range(30_000).select(F.lit("http://example.com/en/hot").alias("url"))
    others = spark.range(3000).select(F.concat(
        F.when(F.col("id") % 2 == 0, "http://net/fr/ads/").otherwise("http://com/page/"), F.col("id")).alias("url"))
    rest = spark.createDataFrame([("http://x.org/ads/1",), ("http://x.org/page/1",)], "url string")
    pages = hot.unionByName(others).unionByName(rest).withColumn("page_id", F.lit(1))
    got = judge_urls(pages, fit_rows=500).groupBy("verdict").count().collect()
    assert {r.verdict: r["count"] for r in got}["block"] >= 31_500
    unknown = judge_urls(pages, fit_rows=500).where("rule is null").collect()
    assert len(unknown) == 2 and all(0.0 <= r.block_score <= 1.0 for r in unknown)
