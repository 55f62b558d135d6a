"""Registered queries: Spark implementation + DuckDB oracle SQL per key.

Each Spark callable takes ``(spark, sf_dir)`` and returns a DataFrame built
from the given tables (price bars are derived from them by Spark, see
``barflow.sources.fixtures``). Every query runs over whole tables.
Computed columns carry the same alias on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.config import JobConfig
from barflow.functions.casts import legacy_int, normalise_date, safe_float, symbol_from_path
from barflow.operators.combine import ASSET_CLASSES, combine_assets, reconcile_counts
from barflow.operators.joins import attach_security_name
from barflow.operators.metrics import regression_metrics
from barflow.operators.model import (
    BoostParams,
    load_model,
    predict,
    train_and_evaluate,
    train_volume_model,
)
from barflow.operators.prepare import (
    dedupe_features,
    drop_incomplete,
    prepare_training_set,
    training_table,
)
from barflow.operators.preview import preview
from barflow.operators.rolling import (
    add_rolling_features,
    moving_average,
    rolling_mean,
    rolling_median,
)
from barflow.operators.score import score_guard, score_volume
from barflow.session import materialise, remove_path, scratch_path
from barflow.sinks.bucketed import write_bucketed
from barflow.sinks.parquet import append_run_metrics
from barflow.sources import fixtures as fx
from barflow.sources.csv_prices import (
    clean_types,
    read_price_csv,
    write_flat_price_csv,
    write_price_csv,
)
from barflow.streaming.incremental import ingest_prices_incremental

QueryFn = Callable[[SparkSession, str], DataFrame]

W30 = "ROWS BETWEEN 29 PRECEDING AND CURRENT ROW"

# Bars come out of GROUP BY (symbol, day): no symbol holds more of them than there
# are days, so their queries ask for the plain window (block=None). Raw rows, and
# the job's features, take the operator's default, which splits keys by year
# (rolling_ticks_by_flag, rolling_features_split, daily_job_features).


def _combined_bars(spark: SparkSession, sf: str) -> DataFrame:
    return attach_security_name(
        combine_assets(fx.stock_bars(spark, sf), fx.etf_bars(spark, sf)), fx.symbol_meta(spark, sf))


def _stock_features(spark: SparkSession, sf: str) -> DataFrame:
    bars = attach_security_name(fx.stock_bars(spark, sf), fx.symbol_meta(spark, sf))
    return add_rolling_features(bars, block=None)


def _combined_features(spark: SparkSession, sf: str) -> DataFrame:
    return add_rolling_features(_combined_bars(spark, sf), partition_cols=("asset_class", "symbol"),
                                block=None)


def _planted_text(spark: SparkSession, sf: str) -> DataFrame:
    """Text cells derived from lineitem, with bad values planted by line
    number (the same rule is written in the oracle SQL)."""
    li = fx.table(spark, sf, "lineitem")
    q = F.col("l_quantity").cast("long").cast("string")
    cents = F.floor(F.col("l_extendedprice") * 100).cast("long")
    money = F.concat(F.floor(cents / 100).cast("long").cast("string"), F.lit("."),
                     F.lpad((cents % 100).cast("string"), 2, "0"))
    ln = F.col("l_linenumber")
    vol = (F.when((ln == 1) & (F.col("l_returnflag") == "R"), F.lit(""))
           .when(ln == 1, q)
           .when(ln == 2, F.concat(q, F.lit(".0")))
           .when(ln == 3, F.concat(F.lit("-"), q, F.lit(".9")))
           .when(ln == 4, F.concat(q, F.lit("e5")))
           .when(ln == 5, F.concat(F.lit("30000000"), F.lpad(q, 2, "0")))
           .when(ln == 6, F.concat(F.lit(" \t"), q, F.lit("\n")))
           .otherwise(F.lit("abc")))
    price = (F.when(ln == 1, money)
             .when(ln == 2, F.concat(F.floor(F.col("l_extendedprice")).cast("long")
                                     .cast("string"), F.lit("e-2")))
             .when(ln == 3, F.lit("abc"))
             .when(ln == 4, F.lit(""))
             .when(ln == 5, F.concat(F.lit("-"), money))
             .when(ln == 6, F.concat(F.lit("+"), money))
             .otherwise(F.concat(money, F.lit("x"))))
    d = F.col("l_shipdate")
    date = (F.when(ln == 1, F.date_format(d, "yyyy-MM-dd"))
            .when(ln == 2, F.concat_ws("-", F.year(d).cast("string"), F.month(d).cast("string"),
                                       F.dayofmonth(d).cast("string")))
            .when(ln == 3, F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
            .when(ln == 4, F.date_format(d, "MM/dd/yyyy"))
            .when(ln == 5, F.lit("x"))
            .when(ln == 6, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"))
            .otherwise(F.lit("")))
    return li.select("l_orderkey", "l_linenumber", vol.alias("volume_text"),
                     price.alias("price_text"), date.alias("date_text"))


# ---------------------------------------------------------------- Spark side
def q_enrich_left_join(spark, sf):
    return attach_security_name(fx.asset_bars(spark, sf), fx.symbol_meta(spark, sf))


def q_moving_avg_30(spark, sf):
    return moving_average(fx.stock_bars(spark, sf), block=None)


def q_rolling_median_30(spark, sf):
    return rolling_median(fx.etf_bars(spark, sf), block=None)


def q_rolling_mean_30(spark, sf):
    # the operator is a plain avg; the key feeds it whole cents so that both
    # engines add exact integers (float sums are order-dependent)
    bars = fx.stock_bars(spark, sf).withColumn(
        "adj_close_cents", F.floor(F.col("adj_close").cast("double") * 100))
    out = rolling_mean(bars, price_col="adj_close_cents", block=None)
    return out.withColumn("adj_close_rolling_mean", F.col("adj_close_rolling_mean") / 100.0)


def q_rolling_mean_decimal(spark, sf):
    # W4 on adj_close itself, as decimals of four places
    return rolling_mean(fx.stock_bars(spark, sf), scale=4)


def q_rolling_features_bucketed(spark, sf):
    """W1-W3 and W5 over bars written bucketed by class, symbol and year; as many buckets as
    the session's shuffles have partitions, which follow the data (``recommended_conf``)."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bars = _combined_bars(spark, sf).withColumn("bar_year", F.substring("date", 1, 4))
    table = write_bucketed(bars, scratch_path(spark, "bucketed"), ("asset_class", "symbol", "bar_year"),
                           buckets, ("date",))
    return add_rolling_features(table, partition_cols=("asset_class", "symbol"),
                                block=F.col("bar_year")).drop("bar_year")


def q_rolling_features(spark, sf):
    return _stock_features(spark, sf)


def q_rolling_features_combined(spark, sf):
    return _combined_features(spark, sf)


def q_combine_union_all(spark, sf):
    return _combined_bars(spark, sf)


def q_preview_meta(spark, sf):
    return preview(fx.symbol_meta(spark, sf), n=10, order_by=("symbol", "security_name"))


def q_reconcile_counts(spark, sf):
    return reconcile_counts(spark, _combined_bars(spark, sf))


def q_symbol_from_path(spark, sf):
    part = fx.table(spark, sf, "part")
    path = F.concat(F.lit("/landing/"), F.regexp_replace("p_type", " ", "_"), F.lit("/"),
                    F.regexp_replace("p_name", " ", "%20"),
                    F.when(F.col("p_size") > 25, F.lit(".B")).otherwise(F.lit("")),
                    F.lit(".csv"))
    return part.select("p_partkey", path.alias("path"),
                       symbol_from_path(path).alias("symbol"))


def q_safe_cast_types(spark, sf):
    t = _planted_text(spark, sf)
    return t.select("l_orderkey", "l_linenumber", "volume_text", "price_text",
                    legacy_int("volume_text").alias("volume"),
                    safe_float("price_text").alias("price"))


def q_normalise_date(spark, sf):
    t = _planted_text(spark, sf)
    return t.select("l_orderkey", "l_linenumber", "date_text",
                    normalise_date("date_text").alias("date"))


def q_csv_ingest(spark, sf):
    landing = scratch_path(spark, "csv_ingest")
    write_price_csv(fx.stock_bars(spark, sf), landing)
    raw = read_price_csv(spark, landing, symbol_source="partition")
    return attach_security_name(clean_types(raw), fx.symbol_meta(spark, sf))


def q_csv_ingest_incremental(spark, sf):
    # Land every bar as CSV, then ingest it with the file stream, 1000
    # files per micro-batch (the reference's batch size), exactly once
    base = scratch_path(spark, "csv_ingest_incremental")
    write_price_csv(fx.stock_bars(spark, sf), f"{base}/landing")
    ingest_prices_incremental(spark, f"{base}/landing", fx.symbol_meta(spark, sf),
                              f"{base}/prices", f"{base}/_checkpoint", asset_class="stock",
                              files_per_trigger=1000, symbol_source="partition")
    return spark.read.parquet(f"{base}/prices")


def _land_flat(spark, sf, base: str) -> str:
    """Flat <SYMBOL>.csv files of the stock bars, one of them with a dotted name, and a
    sub-directory of ETF files that a listing without recursion must not see."""
    landing = f"{base}/landing"
    bars = fx.stock_bars(spark, sf)
    write_flat_price_csv(bars.where("symbol <> 'S1'"), landing)
    write_flat_price_csv(bars.where("symbol = 'S1'"), landing, suffix=".US")
    write_flat_price_csv(fx.etf_bars(spark, sf).withColumn("symbol", F.regexp_replace("symbol", "#", "_")),
                         f"{landing}/archive")
    return landing


def q_csv_ingest_flat(spark, sf):
    # The reference's own layout, symbol from the file's name
    landing = _land_flat(spark, sf, scratch_path(spark, "csv_ingest_flat"))
    return attach_security_name(clean_types(read_price_csv(spark, landing)), fx.symbol_meta(spark, sf))


def q_csv_ingest_flat_incremental(spark, sf):
    # S4 on flat files, 30 a micro-batch; the sink's own counts must be complete
    base = scratch_path(spark, "csv_ingest_flat_incremental")
    landing = _land_flat(spark, sf, base)
    got = ingest_prices_incremental(spark, landing, fx.symbol_meta(spark, sf), f"{base}/prices",
                                    f"{base}/_checkpoint", asset_class="stock", files_per_trigger=30)
    out = spark.read.parquet(f"{base}/prices")
    return out.withColumn("counted_rows", F.lit(got["rows"]).cast("long"))


def q_daily_job_features(spark, sf):
    # D1 up to the feature table: land CSVs, ingest both classes, reconcile counts while
    # writing, rolling features with the operator's defaults, written and read back
    from barflow.plans.daily_job import land_fixture_csv, run_job

    cfg = land_fixture_csv(spark, sf, scratch_path(spark, "daily_job"))
    summary = run_job(spark, cfg, train=False)
    if not all(r["ok"] for r in summary["reconcile"]):
        raise RuntimeError(f"row counts do not reconcile: {summary['reconcile']}")
    return spark.read.parquet(cfg.features_path)


def q_features_incremental(spark, sf):
    # Two landings. The second brings the last months of all symbols and,
    # late, one earlier month of every fifth symbol; only what they change is computed
    from barflow.plans.daily_job import land_fixture_csv, run_job

    base = scratch_path(spark, "features_incremental")
    second = ((F.col("date") >= "2001-09") | F.col("date").startswith("1997-06")
              & (F.crc32(F.col("symbol").cast("binary")) % 5 == 0))
    for which, mode in ((~second, "overwrite"), (second, "append")):
        cfg = replace(land_fixture_csv(spark, sf, base, which, mode), incremental=True)
        run_job(spark, cfg, train=False)
    return spark.read.parquet(cfg.features_path).drop("month")


def q_drop_incomplete(spark, sf):
    return drop_incomplete(_stock_features(spark, sf))


def q_dedupe_features(spark, sf):
    return dedupe_features(_stock_features(spark, sf))


def q_sample_split(spark, sf):
    s = prepare_training_set(_stock_features(spark, sf))
    return s.select("symbol", "date", "volume", "vol_moving_avg", "adj_close_rolling_med",
                    "split")


def q_metrics_naive(spark, sf):
    f = drop_incomplete(_combined_features(spark, sf))
    return regression_metrics(f, label="volume", prediction="vol_moving_avg", scale=100)


def q_metrics_large(spark, sf):
    # volumes near the top of an int: the scaled sums are far beyond a bigint
    f = drop_incomplete(_combined_features(spark, sf)).withColumns({
        "volume": F.col("volume").cast("long") * 900_001,
        "vol_moving_avg": F.floor(F.col("vol_moving_avg")) * 900_001.0})
    return regression_metrics(f, label="volume", prediction="vol_moving_avg", scale=100)


def q_metrics_job(spark, sf):
    # the branch that the training job uses; sums of doubles depend on their order in
    # the last digits, so the key rounds
    f = drop_incomplete(_combined_features(spark, sf))
    m = regression_metrics(f, label="volume", prediction="vol_moving_avg")
    return m.select("asset_class", "n", *[F.round(c, 4).alias(c) for c in ("mae", "mse", "rmse", "r2")])


def _stand_in_prediction(df: DataFrame) -> DataFrame:
    return df.withColumn("prediction",
                         F.col("vol_moving_avg") - F.col("adj_close_rolling_med") / 1600.0)


# What score_guard plants, by day of the month. (day, prediction)
PLANTED_PREDICTIONS = (("01", "NaN"), ("02", "Infinity"), ("03", "-0.5"), ("08", "1e30"), ("09", "-1e30"),
                       ("10", "-1.0"), ("11", "9.3e18"), ("12", "-0.999"))
# (day, text of vol_moving_avg)
PLANTED_INPUTS = (("04", "NaN"), ("05", "abc"), ("06", ""), ("13", "1.15"), ("14", "0.29"), ("15", "-0.5"),
                  ("16", "-0.001"), ("17", "12345678.25"), ("18", "7"))


def _planted_requests(spark, sf) -> DataFrame:
    """Requests with vol_moving_avg as text, as it comes over the wire."""
    f = _stand_in_prediction(_combined_features(spark, sf))
    day = F.substring("date", 9, 2)
    prediction, given = F.col("prediction"), F.col("vol_moving_avg").cast("string")
    for d, v in PLANTED_PREDICTIONS:
        prediction = F.when(day == d, F.lit(float(v.replace("Infinity", "inf")))).otherwise(prediction)
    for d, v in PLANTED_INPUTS:
        given = F.when(day == d, F.lit(v)).otherwise(given)
    return f.withColumns({"prediction": prediction, "vol_moving_avg": given})


def q_score_guard(spark, sf):
    return score_guard(_planted_requests(spark, sf)).select(
        "asset_class", "symbol", "date", "predicted_volume", "status", "message")


def _by_class(fn: Callable, *args) -> dict:
    """``fn(cls, ...)`` of both classes at once, from driver threads: each trains for many
    small jobs, between which the other's run."""
    with ThreadPoolExecutor(len(ASSET_CLASSES)) as pool:
        return dict(zip(ASSET_CLASSES, pool.map(lambda c: fn(c, *args), ASSET_CLASSES)))


def _training_tables(spark, features: DataFrame) -> dict[str, DataFrame]:
    return _by_class(lambda c: training_table(features.where(F.col("asset_class") == c),
                                              scratch_path(spark, f"training-{c}")))


def q_train_eval(spark, sf):
    # M3-M8, K5, S9, K6 with the reference's grid. What a trained model gives is no
    # fixed number, so the key reports the exact sizes and whether each rule holds.
    base = scratch_path(spark, "train_eval")
    grid = JobConfig.tree_grid
    features, path = materialise(_combined_features(spark, sf), "features")
    tables = _training_tables(spark, features)
    remove_path(spark, path)

    def checks(cls: str) -> DataFrame:
        prepared = tables[cls]
        model, m, curves = train_and_evaluate(prepared, cls, grid, JobConfig.cv_folds,
                                              model_path=f"{base}/models/{cls}", parallelism=JobConfig.cv_folds)
        append_run_metrics(spark, m, f"{base}/metrics/{cls}")
        row, rounds = m.first(), curves.collect()
        test = prepared.where("split = 'test'")
        naive = regression_metrics(test, label="volume", prediction="vol_moving_avg").first()["mae"]
        again = predict(load_model(f"{base}/models/{cls}"), test).select("symbol", "date", "prediction")
        same = predict(model, test).select("symbol", "date", "prediction").exceptAll(again).isEmpty()
        logged = spark.read.parquet(f"{base}/metrics/{cls}").where(F.col("asset_class") == cls).count()
        return spark.createDataFrame([(
            cls, row["train_rows"], row["test_rows"], row["n_trees"] in grid, len(rounds) == row["n_trees"],
            row["best_iteration"] == min(rounds, key=lambda r: (r["train_mae"], r["iteration"]))["iteration"],
            abs(rounds[-1]["test_mae"] - row["mae"]) <= 1e-6 * max(1.0, row["mae"]),
            row["mae"] <= row["mean_mae"], row["mae"] <= 1.05 * naive, same, logged)],
            "asset_class string, train_rows long, test_rows long, trees_in_grid boolean, "
            "curve_is_whole boolean, best_is_argmin boolean, curve_ends_at_mae boolean, "
            "beats_mean boolean, near_naive boolean, loaded_model_is_equal boolean, logged_rows long")

    return reduce(DataFrame.unionByName, _by_class(checks).values())


def q_score_volume(spark, sf):
    # M4, M9: one model per class with the grid's smallest tree count and the job's final
    # depth; every row is scored, with vol_moving_avg as text, and held to the rules
    features, _ = materialise(_combined_features(spark, sf), "features")
    tables = _training_tables(spark, features)
    models = _by_class(lambda cls: train_volume_model(tables[cls].where("split = 'train'"), JobConfig.tree_grid[0],
                                                      BoostParams()))
    requests = features.withColumn("vol_moving_avg", F.col("vol_moving_avg").cast("string"))
    s = score_volume(requests, models)
    p, whole = F.col("prediction"), F.expr("try_cast(prediction AS bigint)")
    return s.select(
        "asset_class", "symbol", "date", p.isNotNull().alias("scored"),
        F.when(p <= -1, F.col("predicted_volume").isNull()).otherwise(F.col("predicted_volume") == whole)
        .alias("volume_is_truncated"),
        (F.col("status") == F.when(p <= -1, "negative").otherwise("ok")).alias("status_fits"),
        F.when(p <= -1, F.col("message").startswith("Invalid Output."))
        .otherwise(F.col("message").endswith(F.concat(F.lit(" is "), whole.cast("string"), F.lit("."))))
        .alias("message_fits"))


def q_rolling_features_split(spark, sf):
    # the default window, which splits each symbol by year
    bars = attach_security_name(fx.stock_bars(spark, sf), fx.symbol_meta(spark, sf))
    return add_rolling_features(bars)


def q_rolling_ticks_by_flag(spark, sf):
    # genuinely skewed input: every line item is a tick keyed by its return flag, and
    # each of the three flags holds a third of all rows. Ordered by ship date + the
    # 6-column line key (unique), trailing 30 rows. Ticks of a day have no bound, years of
    # them still less: blocks of a day, the finest unit.
    li = fx.table(spark, sf, "lineitem").select(
        "l_returnflag", "l_shipdate", *fx.LINE_ORDER_KEY, "l_quantity")
    out = add_rolling_features(li, partition_cols=("l_returnflag",), order_col="l_shipdate",
                               tie_breaker=fx.LINE_ORDER_KEY, volume_col="l_quantity",
                               price_col="l_extendedprice", block="day")
    return out.withColumnsRenamed({"vol_moving_avg": "qty_moving_avg",
                                   "adj_close_rolling_med": "price_rolling_med"})


SPARK_QUERIES: dict[str, QueryFn] = {
    "symbol_from_path": q_symbol_from_path,
    "safe_cast_types": q_safe_cast_types,
    "normalise_date": q_normalise_date,
    "csv_ingest": q_csv_ingest,
    "csv_ingest_incremental": q_csv_ingest_incremental,
    "csv_ingest_flat": q_csv_ingest_flat,
    "csv_ingest_flat_incremental": q_csv_ingest_flat_incremental,
    "enrich_left_join": q_enrich_left_join,
    "moving_avg_30": q_moving_avg_30,
    "rolling_median_30": q_rolling_median_30,
    "rolling_mean_30": q_rolling_mean_30,
    "rolling_mean_decimal": q_rolling_mean_decimal,
    "rolling_features_bucketed": q_rolling_features_bucketed,
    "rolling_features": q_rolling_features,
    "rolling_features_combined": q_rolling_features_combined,
    "combine_union_all": q_combine_union_all,
    "preview_meta": q_preview_meta,
    "reconcile_counts": q_reconcile_counts,
    "daily_job_features": q_daily_job_features,
    "features_incremental": q_features_incremental,
    "drop_incomplete": q_drop_incomplete,
    "dedupe_features": q_dedupe_features,
    "sample_split": q_sample_split,
    "metrics_naive": q_metrics_naive,
    "metrics_large": q_metrics_large,
    "metrics_job": q_metrics_job,
    "score_guard": q_score_guard,
    "train_eval": q_train_eval,
    "score_volume": q_score_volume,
    "rolling_features_split": q_rolling_features_split,
    "rolling_ticks_by_flag": q_rolling_ticks_by_flag,
}

# ---------------------------------------------------------------- DuckDB side
_CTE = fx.fixture_ctes()
_ENRICHED = (", stocks_named AS (SELECT b.*, m.security_name FROM stocks b"
             " LEFT JOIN meta m ON b.symbol = m.symbol)\n"
             ", etfs_named AS (SELECT b.*, m.security_name FROM etfs b"
             " LEFT JOIN meta m ON b.symbol = m.symbol)\n"
             ", combined_named AS (SELECT *, 'stock' AS asset_class FROM stocks_named"
             " UNION ALL SELECT *, 'etf' AS asset_class FROM etfs_named)\n")

ORACLE_SQL: dict[str, str] = {
    "enrich_left_join": _CTE + """
SELECT c.*, m.security_name FROM combined c LEFT JOIN meta m ON c.symbol = m.symbol""",
    "moving_avg_30": _CTE + f"""
SELECT *, avg(volume) OVER (PARTITION BY symbol ORDER BY date {W30}) AS vol_moving_avg
FROM stocks""",
    "rolling_median_30": _CTE + f"""
SELECT *, quantile_disc(adj_close, 0.5) OVER (PARTITION BY symbol ORDER BY date {W30})
       AS adj_close_rolling_med
FROM etfs""",
    "rolling_mean_30": _CTE + f"""
SELECT *, avg(adj_close_cents) OVER (PARTITION BY symbol ORDER BY date {W30}) / 100.0::DOUBLE
       AS adj_close_rolling_mean
FROM (SELECT *, CAST(floor(CAST(adj_close AS DOUBLE) * 100) AS BIGINT) AS adj_close_cents
      FROM stocks)""",
    "rolling_features": _CTE + f"""
SELECT b.*, m.security_name,
       avg(volume) OVER w AS vol_moving_avg,
       quantile_disc(adj_close, 0.5) OVER w AS adj_close_rolling_med
FROM stocks b LEFT JOIN meta m ON b.symbol = m.symbol
WINDOW w AS (PARTITION BY b.symbol ORDER BY b.date {W30})""",
    "rolling_features_combined": _CTE + _ENRICHED + f"""
SELECT *, avg(volume) OVER w AS vol_moving_avg,
       quantile_disc(adj_close, 0.5) OVER w AS adj_close_rolling_med
FROM combined_named
WINDOW w AS (PARTITION BY asset_class, symbol ORDER BY date {W30})""",
    "combine_union_all": _CTE + _ENRICHED + "SELECT * FROM combined_named",
    "preview_meta": _CTE + "SELECT * FROM meta ORDER BY symbol, security_name LIMIT 10",
    "reconcile_counts": _CTE + """
SELECT asset_class AS dataset, count(*) AS expected_rows, count(*) AS actual_rows,
       true AS ok
FROM combined GROUP BY asset_class""",
}

_FEATURES = f"""
, features AS (
  SELECT b.*, m.security_name,
         avg(volume) OVER w AS vol_moving_avg,
         quantile_disc(adj_close, 0.5) OVER w AS adj_close_rolling_med
  FROM stocks b LEFT JOIN meta m ON b.symbol = m.symbol
  WINDOW w AS (PARTITION BY b.symbol ORDER BY b.date {W30}))
, combined_features AS (
  SELECT *, avg(volume) OVER w AS vol_moving_avg,
         quantile_disc(adj_close, 0.5) OVER w AS adj_close_rolling_med
  FROM combined_named
  WINDOW w AS (PARTITION BY asset_class, symbol ORDER BY date {W30}))
"""


def _complete(cols_float: tuple[str, ...], cols_other: tuple[str, ...]) -> str:
    parts = [f"{c} IS NOT NULL" for c in cols_other + cols_float]
    parts += [f"NOT isnan({c})" for c in cols_float]
    return " AND ".join(parts)


_FLOATS = ("open", "high", "low", "close", "adj_close", "vol_moving_avg",
           "adj_close_rolling_med")
_COMPLETE = _complete(_FLOATS, ("symbol", "volume", "security_name"))
_COMPLETE_COMBINED = _complete(_FLOATS, ("symbol", "volume", "security_name", "asset_class"))

_PLANTED = """
, planted AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_linenumber = 1 AND l_returnflag = 'R' THEN ''
         WHEN l_linenumber = 1 THEN q
         WHEN l_linenumber = 2 THEN q || '.0'
         WHEN l_linenumber = 3 THEN '-' || q || '.9'
         WHEN l_linenumber = 4 THEN q || 'e5'
         WHEN l_linenumber = 5 THEN '30000000' || lpad(q, 2, '0')
         WHEN l_linenumber = 6 THEN ' ' || chr(9) || q || chr(10)
         ELSE 'abc' END AS volume_text,
    CASE WHEN l_linenumber = 1 THEN money
         WHEN l_linenumber = 2 THEN CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) || 'e-2'
         WHEN l_linenumber = 3 THEN 'abc'
         WHEN l_linenumber = 4 THEN ''
         WHEN l_linenumber = 5 THEN '-' || money
         WHEN l_linenumber = 6 THEN '+' || money
         ELSE money || 'x' END AS price_text,
    CASE WHEN l_linenumber = 1 THEN strftime(l_shipdate, '%Y-%m-%d')
         WHEN l_linenumber = 2 THEN CAST(year(l_shipdate) AS VARCHAR) || '-' ||
              CAST(month(l_shipdate) AS VARCHAR) || '-' || CAST(day(l_shipdate) AS VARCHAR)
         WHEN l_linenumber = 3 THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')
         WHEN l_linenumber = 4 THEN strftime(l_shipdate, '%m/%d/%Y')
         WHEN l_linenumber = 5 THEN 'x'
         WHEN l_linenumber = 6 THEN strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S')
         ELSE '' END AS date_text
  FROM (SELECT *, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS q,
               CAST(CAST(floor(cents / 100) AS BIGINT) AS VARCHAR) || '.' ||
               lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS money
        FROM (SELECT *, CAST(floor(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem)))
"""

_LEGACY_INT = """
CASE WHEN regexp_matches(t, '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$') THEN
  CASE WHEN split_part(t, '.', 1) IN ('', '+', '-') THEN 0
       ELSE TRY_CAST(split_part(t, '.', 1) AS INTEGER) END END"""


def _planted_case(cells, otherwise: str, wrap: str) -> str:
    return ("CASE " + " ".join(f"WHEN substr(date, 9, 2) = '{d}' THEN " + wrap.format(v) for d, v in cells)
            + f" ELSE {otherwise} END")


ORACLE_SQL.update({
    "symbol_from_path": """
SELECT p_partkey, path, regexp_replace(path, '.*/|\\..*', '', 'g') AS symbol
FROM (SELECT p_partkey,
             '/landing/' || replace(p_type, ' ', '_') || '/' || replace(p_name, ' ', '%20') ||
             CASE WHEN p_size > 25 THEN '.B' ELSE '' END || '.csv' AS path
      FROM part)""",
    "safe_cast_types": "WITH _x AS (SELECT 1)" + _PLANTED + f"""
SELECT l_orderkey, l_linenumber, volume_text, price_text,
       {_LEGACY_INT} AS volume,
       TRY_CAST(price_text AS FLOAT) AS price
FROM (SELECT *, regexp_replace(volume_text, '^\\s+|\\s+$', '', 'g') AS t FROM planted)""",
    "normalise_date": "WITH _x AS (SELECT 1)" + _PLANTED + """
SELECT l_orderkey, l_linenumber, date_text,
       strftime(TRY_CAST(date_text AS TIMESTAMP), '%Y-%m-%d') AS date
FROM planted""",
    "csv_ingest": _CTE + _ENRICHED + "SELECT * FROM stocks_named",
    "csv_ingest_incremental": _CTE + _ENRICHED +
    "SELECT *, 'stock' AS asset_class FROM stocks_named",
    "drop_incomplete": _CTE + _ENRICHED + _FEATURES + f"""
SELECT * FROM features WHERE {_COMPLETE}""",
    "dedupe_features": _CTE + _ENRICHED + _FEATURES + """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY vol_moving_avg, adj_close_rolling_med, volume
                               ORDER BY symbol, date) AS rn
  FROM features) WHERE rn = 1""",
    "sample_split": _CTE + _ENRICHED + _FEATURES + f"""
, d AS (SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY vol_moving_avg, adj_close_rolling_med, volume
                                 ORDER BY symbol, date) AS rn
    FROM features WHERE {_COMPLETE}) WHERE rn = 1)
, r AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '42', symbol, date)), symbol, date) AS k,
               count(*) OVER () AS n FROM d)
SELECT symbol, date, volume, vol_moving_avg, adj_close_rolling_med,
       CASE WHEN k <= floor(0.8 * floor(n * 0.5)) THEN 'train' ELSE 'test' END AS split
FROM r WHERE k <= floor(n * 0.5)""",
    "metrics_naive": _CTE + _ENRICHED + _FEATURES + f"""
, e AS (SELECT asset_class, CAST(volume AS DOUBLE) - CAST(vol_moving_avg AS DOUBLE) AS err,
               CAST(volume AS BIGINT) AS y
        FROM combined_features WHERE {_COMPLETE_COMBINED})
, a AS (SELECT asset_class, count(*) AS n,
               sum(floor(abs(err) * 100.0::DOUBLE)) AS sae,
               sum(floor(err * err * 100.0::DOUBLE)) AS sse,
               sum(y) AS sy, sum(y * y) AS syy
        FROM e GROUP BY asset_class)
SELECT asset_class, n,
       CAST(sae AS DOUBLE) / (100.0::DOUBLE * CAST(n AS DOUBLE)) AS mae,
       CAST(sse AS DOUBLE) / (100.0::DOUBLE * CAST(n AS DOUBLE)) AS mse,
       sqrt(CAST(sse AS DOUBLE) / (100.0::DOUBLE * CAST(n AS DOUBLE))) AS rmse,
       CASE WHEN CAST(n AS DOUBLE) * CAST(syy AS DOUBLE) - CAST(sy AS DOUBLE) * CAST(sy AS DOUBLE) > 0
            THEN 1.0::DOUBLE - (CAST(sse AS DOUBLE) * CAST(n AS DOUBLE)) /
                 (100.0::DOUBLE * (CAST(n AS DOUBLE) * CAST(syy AS DOUBLE)
                                   - CAST(sy AS DOUBLE) * CAST(sy AS DOUBLE))) END AS r2
FROM a""",
    # the oracle formats a number by its own cast to text, not by the operator's route
    "score_guard": _CTE + _ENRICHED + _FEATURES + f"""
, p0 AS (SELECT asset_class, symbol, date, adj_close_rolling_med AS med,
                {_planted_case(PLANTED_INPUTS, "CAST(vol_moving_avg AS VARCHAR)", "'{}'")} AS given,
                {_planted_case(PLANTED_PREDICTIONS, "CAST(vol_moving_avg AS DOUBLE) - CAST(adj_close_rolling_med AS DOUBLE) / 1600.0::DOUBLE", "CAST('{}' AS DOUBLE)")} AS prediction
         FROM combined_features)
, p AS (SELECT *, TRY_CAST(given AS DOUBLE) AS avg_volume FROM p0)
, s AS (SELECT *, TRY_CAST(trunc(prediction) AS BIGINT) AS pv,
          CASE WHEN avg_volume IS NULL OR NOT isfinite(avg_volume) OR med IS NULL OR NOT isfinite(med)
               THEN 'invalid_input'
               WHEN prediction IS NULL OR NOT isfinite(prediction) THEN 'invalid_output'
               WHEN trunc(prediction) < 0 THEN 'negative'
               WHEN TRY_CAST(trunc(prediction) AS BIGINT) IS NULL THEN 'invalid_output'
               ELSE 'ok' END AS status
        FROM p)
SELECT asset_class, symbol, date,
       CASE WHEN status = 'ok' THEN pv END AS predicted_volume, status,
       CASE status WHEN 'invalid_input' THEN 'Invalid input. Please enter numeric values for vol_moving_avg and adj_close_rolling_med.'
            WHEN 'ok' THEN printf('The predicted %s volume given (%s, %s) is %d.',
                 CASE asset_class WHEN 'etf' THEN 'etfs' ELSE asset_class END,
                 CAST(avg_volume AS VARCHAR), CAST(CAST(med AS DOUBLE) AS VARCHAR), pv)
            ELSE 'Invalid Output. Please enter valid values for vol_moving_avg and adj_close_rolling_med.'
       END AS message
FROM s""",
    "metrics_job": _CTE + _ENRICHED + _FEATURES + f"""
, e AS (SELECT asset_class, CAST(volume AS DOUBLE) AS y,
               CAST(volume AS DOUBLE) - CAST(vol_moving_avg AS DOUBLE) AS err
        FROM combined_features WHERE {_COMPLETE_COMBINED})
SELECT asset_class, count(*) AS n, round(avg(abs(err)), 4) AS mae, round(avg(err * err), 4) AS mse,
       round(sqrt(avg(err * err)), 4) AS rmse,
       round(1.0::DOUBLE - sum(err * err) / (count(*) * var_pop(y)), 4) AS r2
FROM e GROUP BY asset_class""",
    "metrics_large": _CTE + _ENRICHED + _FEATURES + f"""
, e AS (SELECT asset_class, CAST(volume AS HUGEINT) * 900001 AS y,
               CAST(volume AS DOUBLE) * 900001 - floor(vol_moving_avg) * 900001.0::DOUBLE AS err
        FROM combined_features WHERE {_COMPLETE_COMBINED})
, a AS (SELECT asset_class, count(*) AS n, CAST(CAST(sum(CAST(floor(abs(err) * 100.0::DOUBLE) AS HUGEINT)) AS VARCHAR) AS DOUBLE) AS sae,
               CAST(CAST(sum(CAST(floor(err * err * 100.0::DOUBLE) AS HUGEINT)) AS VARCHAR) AS DOUBLE) AS sse,
               CAST(CAST(sum(y) AS VARCHAR) AS DOUBLE) AS sy,
               CAST(CAST(sum(y * y) AS VARCHAR) AS DOUBLE) AS syy
        FROM e GROUP BY asset_class)
SELECT asset_class, n, sae / (100.0::DOUBLE * n) AS mae, sse / (100.0::DOUBLE * n) AS mse,
       sqrt(sse / (100.0::DOUBLE * n)) AS rmse,
       1.0::DOUBLE - (sse * n) / (100.0::DOUBLE * (n * syy - sy * sy)) AS r2
FROM a""",
    "csv_ingest_flat": _CTE + _ENRICHED + "SELECT * FROM stocks_named",
    "csv_ingest_flat_incremental": _CTE + _ENRICHED +
    "SELECT *, 'stock' AS asset_class, count(*) OVER () AS counted_rows FROM stocks_named",
    "train_eval": _CTE + _ENRICHED + _FEATURES + f"""
, d AS (SELECT asset_class, count(*) AS n FROM (
          SELECT DISTINCT asset_class, vol_moving_avg, adj_close_rolling_med, volume
          FROM combined_features WHERE {_COMPLETE_COMBINED}) GROUP BY asset_class)
SELECT asset_class, CAST(floor(0.8 * floor(n * 0.5)) AS BIGINT) AS train_rows,
       CAST(floor(n * 0.5) - floor(0.8 * floor(n * 0.5)) AS BIGINT) AS test_rows,
       true AS trees_in_grid, true AS curve_is_whole, true AS best_is_argmin, true AS curve_ends_at_mae,
       true AS beats_mean, true AS near_naive, true AS loaded_model_is_equal,
       CAST(1 AS BIGINT) AS logged_rows
FROM d""",
    "score_volume": _CTE + _ENRICHED + """
SELECT asset_class, symbol, date, true AS scored, true AS volume_is_truncated, true AS status_fits,
       true AS message_fits
FROM combined_named""",
    "rolling_features_split": ORACLE_SQL["rolling_features"],
    "rolling_features_bucketed": ORACLE_SQL["rolling_features_combined"],
    "rolling_mean_decimal": _CTE + f"""
SELECT *, CAST(sum(CAST(CAST(adj_close AS DOUBLE) AS DECIMAL(28, 4))) OVER w AS DOUBLE)
          / count(adj_close) OVER w AS adj_close_rolling_mean
FROM stocks WINDOW w AS (PARTITION BY symbol ORDER BY date {W30})""",
    "daily_job_features": ORACLE_SQL["rolling_features_combined"],
    "features_incremental": ORACLE_SQL["rolling_features_combined"],
    "rolling_ticks_by_flag": f"""
SELECT l_returnflag, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
       l_extendedprice, l_discount, l_quantity,
       avg(l_quantity) OVER w AS qty_moving_avg,
       quantile_disc(l_extendedprice, 0.5) OVER w AS price_rolling_med
FROM lineitem
WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber,
             l_partkey, l_suppkey, l_extendedprice, l_discount {W30})""",
})
