"""Daily price bars derived from the TPC-H-style tables.

The test tables hold no prices, so bars are *derived* by Spark from them
(work grows with the tables):

* stocks: one symbol per supplier, one bar per ship day
  (``'S' || l_suppkey``), from ``lineitem``;
* ETFs: one symbol per part brand (a brand is a basket of parts), from
  ``lineitem JOIN part``;
* meta: suppliers with a positive balance plus every brand; deliberately
  incomplete so the left join misses some stocks.

open/close are the first/last line by a 6-column tie-break (order key +
line number alone is not unique in this data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.operators.joins import bounded_broadcast

# The tie-break key that orders lines inside one (symbol, day).
LINE_ORDER_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                  "l_extendedprice", "l_discount")
BAR_COLUMNS = ("symbol", "date", "open", "high", "low", "close", "adj_close", "volume")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _bars(lines: DataFrame, group_key: F.Column, symbol: F.Column) -> DataFrame:
    """One bar per (group_key, ship day). Grouping runs on the narrow key
    (numeric for stocks); the symbol text is built after aggregation.

    open/close/adj_close use a struct ordering key, whose variable-width buffer
    plans a sort-based aggregate; it still aggregates partially before the
    shuffle, so a hot (symbol, day) never lands whole in one task.
    """
    key = F.struct(*LINE_ORDER_KEY)
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return (
        lines.groupBy(group_key.alias("_key"), F.to_date("l_shipdate").alias("_day"))
        .agg(
            F.min_by("l_extendedprice", key).cast("float").alias("open"),
            F.max("l_extendedprice").cast("float").alias("high"),
            F.min("l_extendedprice").cast("float").alias("low"),
            # close and adj_close come from the same (last) line: one max_by
            F.max_by(F.struct(F.col("l_extendedprice").alias("p"), net.alias("n")), key)
            .alias("_last"),
            F.sum("l_quantity").cast("int").alias("volume"),
        )
        .withColumns({"symbol": symbol, "date": F.date_format("_day", "yyyy-MM-dd"),
                      "close": F.col("_last.p").cast("float"),
                      "adj_close": F.col("_last.n").cast("float")})
        .select(*BAR_COLUMNS)
    )


def stock_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return _bars(li, F.col("l_suppkey"), F.concat(F.lit("S"), F.col("_key").cast("string")))


def etf_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_brand")
    # part grows with the scale factor: broadcast only below a checked size,
    # otherwise a shuffle join (AQE splits skewed part keys).
    joined = li.join(bounded_broadcast(part), "l_partkey")
    return _bars(joined, F.col("p_brand"), F.col("_key"))


def symbol_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = (
        table(spark, sf_dir, "supplier")
        .where(F.col("s_acctbal") > 0)
        .select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol"),
                F.col("s_name").alias("security_name"))
    )
    brands = (
        table(spark, sf_dir, "part")
        .groupBy(F.col("p_brand").alias("symbol"))
        .agg(F.min("p_type").alias("security_name"))
    )
    return sup.unionByName(brands)


def asset_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both classes in one frame with an ``asset_class`` column."""
    return (stock_bars(spark, sf_dir).withColumn("asset_class", F.lit("stock"))
            .unionByName(etf_bars(spark, sf_dir).withColumn("asset_class", F.lit("etf"))))


# DuckDB twins of the views above, used by the oracle SQL of the queries.
STOCKS_SQL = """
SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol,
       strftime(l_shipdate, '%Y-%m-%d') AS date,
       CAST(arg_min(l_extendedprice, row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_discount)) AS FLOAT) AS open,
       CAST(max(l_extendedprice) AS FLOAT) AS high,
       CAST(min(l_extendedprice) AS FLOAT) AS low,
       CAST(arg_max(l_extendedprice, row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_discount)) AS FLOAT) AS close,
       CAST(arg_max(l_extendedprice * (1 - l_discount), row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_discount)) AS FLOAT) AS adj_close,
       CAST(sum(l_quantity) AS INTEGER) AS volume
FROM lineitem GROUP BY 1, 2
"""

ETFS_SQL = """
SELECT p_brand AS symbol,
       strftime(l_shipdate, '%Y-%m-%d') AS date,
       CAST(arg_min(l_extendedprice, row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_discount)) AS FLOAT) AS open,
       CAST(max(l_extendedprice) AS FLOAT) AS high,
       CAST(min(l_extendedprice) AS FLOAT) AS low,
       CAST(arg_max(l_extendedprice, row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_discount)) AS FLOAT) AS close,
       CAST(arg_max(l_extendedprice * (1 - l_discount), row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_discount)) AS FLOAT) AS adj_close,
       CAST(sum(l_quantity) AS INTEGER) AS volume
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2
"""

META_SQL = """
SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS symbol, s_name AS security_name
FROM supplier WHERE s_acctbal > 0
UNION ALL
SELECT p_brand AS symbol, min(p_type) AS security_name FROM part GROUP BY p_brand
"""


def fixture_ctes() -> str:
    """``WITH`` prefix defining stocks / etfs / meta / combined in DuckDB."""
    return (
        f"WITH stocks AS ({STOCKS_SQL}),\n etfs AS ({ETFS_SQL}),\n meta AS ({META_SQL}),\n"
        " combined AS (SELECT *, 'stock' AS asset_class FROM stocks"
        " UNION ALL SELECT *, 'etf' AS asset_class FROM etfs)\n"
    )
