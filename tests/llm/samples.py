"""Small inputs that every operator must survive."""

from pyspark.sql import functions as F

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
SF_LARGE = "/root/testdata/sf0.1"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_documents(spark):
    """Nulls in any column, empty and blank texts, repeated rows, a long text."""
    long_text = " ".join(f"word{i % 977} tail{i % 13}" for i in range(40_000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n ", "en", "a", 4),
        (4, "one", "en", None, 3), (5, "one two three four five six", None, "b", 27),
        (6, "One TWO three four five six", "de", "b", 27), (7, long_text, "en", "a", len(long_text)),
        (7, long_text, "en", "a", len(long_text)), (8, "éè ñ ß 中文 \U0001f600 x", "fr", "c", 14),
        (None, "no id at all here", "en", "a", 17), (9, "\x00\x01 odd ▁ bytes", "es", "c", 15),
    ]
    return spark.createDataFrame(rows, DOCS)


def with_clashes(df):
    """The same frame with extra columns named like an operator's own."""
    names = ["fp", "n", "key", "score", "root", "a", "b", "t", "_key", "_hash", "epoch", "block",
             "fingerprint", "component_id", "spans", "predicted", "host", "path", "pid", "rank"]
    return df.withColumns({c: F.lit("x") for c in names})
