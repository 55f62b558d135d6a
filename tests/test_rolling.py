"""Trailing 30-row mean / lower median, incl. the hot-key split path."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from barflow.operators.rolling import (
    add_rolling_features,
    moving_average,
    rolling_mean,
    rolling_median,
)

SCHEMA = "symbol string, date string, volume int, adj_close float"


def _dates(n):
    return [(date(2020, 1, 1) + timedelta(days=i)).isoformat() for i in range(n)]


def _sorted(df):
    return [r.asDict() for r in df.orderBy("symbol", "date").collect()]


def test_running_mean_and_lower_median(spark):
    # the reference's only oracle vector: 100, 200, 300 -> mean 100, 150, 200
    df = spark.createDataFrame([("ABC", d, v, float(v)) for d, v in
                                zip(_dates(3), (100, 200, 300))], SCHEMA)
    out = _sorted(add_rolling_features(df))
    assert [r["vol_moving_avg"] for r in out] == [100.0, 150.0, 200.0]
    # lower median of the prefixes {100}, {100,200}, {100,200,300}
    assert [r["adj_close_rolling_med"] for r in out] == [100.0, 100.0, 200.0]


def test_nulls_inside_the_frame(spark):
    vals = [None, 3.0, 1.0, None, 9.0]
    df = spark.createDataFrame([("X", d, None if v is None else int(v), v)
                                for d, v in zip(_dates(5), vals)], SCHEMA)
    out = _sorted(add_rolling_features(df))
    assert [r["adj_close_rolling_med"] for r in out] == [None, 3.0, 1.0, 1.0, 3.0]
    means = [r["vol_moving_avg"] for r in out]
    assert means[0] is None and means[1:4] == [3.0, 2.0, 2.0]
    assert means[4] == pytest.approx(13 / 3)


def test_frame_drops_first_row_at_row_31(spark):
    df = spark.createDataFrame([("X", d, i + 1, float(i + 1)) for i, d in enumerate(_dates(31))],
                               SCHEMA)
    out = _sorted(add_rolling_features(df))
    assert out[29]["vol_moving_avg"] == pytest.approx(sum(range(1, 31)) / 30)
    assert out[30]["vol_moving_avg"] == pytest.approx(sum(range(2, 32)) / 30)
    assert out[30]["adj_close_rolling_med"] == 16.0   # lower median of 2..31


def test_single_feature_operators(spark):
    df = spark.createDataFrame([("A", d, v, float(v)) for d, v in zip(_dates(4), (4, 1, 3, 2))],
                               SCHEMA)
    assert [r["vol_moving_avg"] for r in _sorted(moving_average(df, window_rows=2))] == \
        [4.0, 2.5, 2.0, 2.5]
    assert [r["adj_close_rolling_med"] for r in _sorted(rolling_median(df, window_rows=3))] == \
        [4.0, 1.0, 3.0, 2.0]
    assert [r["adj_close_rolling_mean"] for r in _sorted(rolling_mean(df, window_rows=2))] == \
        [4.0, 2.5, 2.0, 2.5]


def _random_bars(n_symbols=6, n_rows=(40, 400), seed=7, dup_dates=False):
    rnd = random.Random(seed)
    rows = []
    for s in range(n_symbols):
        n = rnd.randint(*n_rows)
        ds = _dates(n)
        for i in range(n):
            d = ds[i // 2] if dup_dates else ds[i]
            vol = None if rnd.random() < 0.05 else rnd.randint(0, 10_000)
            px = None if rnd.random() < 0.05 else float(rnd.randint(1, 500))
            rows.append((f"S{s}", d, vol, px, i))
    return rows


@pytest.mark.parametrize("median_method", ["approx", "exact"])
def test_split_path_equals_single_window(spark, median_method):
    df = spark.createDataFrame(_random_bars(), SCHEMA + ", seq int")
    single = _sorted(add_rolling_features(df, block=None, median_method=median_method))
    for block in ("year", "month", "day", F.lit(0)):      # many rows a block down to one
        assert _sorted(add_rolling_features(df, block=block, median_method=median_method)) == single


def test_split_path_with_tie_breaker(spark):
    # repeated (symbol, date): the tie breaker makes the ROWS order total
    df = spark.createDataFrame(_random_bars(dup_dates=True, seed=3), SCHEMA + ", seq int")
    kw = dict(tie_breaker=("seq",))
    a = add_rolling_features(df, block=None, **kw).orderBy("symbol", "seq").collect()
    b = add_rolling_features(df, block="month", **kw).orderBy("symbol", "seq").collect()
    assert a == b


def test_exact_and_approx_median_agree_on_30_rows(spark):
    df = spark.createDataFrame(_random_bars(seed=11), SCHEMA + ", seq int")
    a = add_rolling_features(df, block=None, median_method="approx")
    b = add_rolling_features(df, block=None, median_method="exact")
    assert _sorted(a) == _sorted(b)


def test_layout_does_not_change_features(spark):
    df = spark.createDataFrame(_random_bars(seed=5), SCHEMA + ", seq int")
    a = _sorted(add_rolling_features(df))
    b = _sorted(add_rolling_features(df.repartition(7).sortWithinPartitions(F.rand(1))))
    assert a == b


def test_partition_by_class_and_symbol(spark):
    rows = [("stock", "T", d, 10, 1.0) for d in _dates(3)] + \
           [("etf", "T", d, 20, 2.0) for d in _dates(3)]
    df = spark.createDataFrame(rows, "asset_class string, symbol string, date string, "
                                     "volume int, adj_close float")
    out = add_rolling_features(df, partition_cols=("asset_class", "symbol")).collect()
    assert {(r["asset_class"], r["vol_moving_avg"]) for r in out} == {("stock", 10.0),
                                                                      ("etf", 20.0)}


def test_rows_that_tie_in_the_order_are_neither_lost_nor_doubled(spark):
    rows = [("X", f"2020-{1 + i // 90:02d}-01", i, float(i), i) for i in range(270)]
    df = spark.createDataFrame(rows, SCHEMA + ", seq int").repartition(5)
    out = add_rolling_features(df, block="month").collect()
    assert sorted(r["seq"] for r in out) == list(range(270))


def test_order_column_types_and_nulls(spark):
    rows = [("A", None if i % 9 == 0 else d, i, float(i % 11)) for i, d in enumerate(_dates(500))]
    df = spark.createDataFrame(rows, SCHEMA)
    want = add_rolling_features(df, block=None, tie_breaker=("volume",)).orderBy("volume").collect()
    assert add_rolling_features(df, tie_breaker=("volume",)).orderBy("volume").collect() == want
    for kind in ("date", "timestamp"):
        typed = df.withColumn("date", F.col("date").cast(kind))
        got = add_rolling_features(typed, tie_breaker=("volume",)).orderBy("volume").collect()
        assert [r[-2:] for r in got] == [r[-2:] for r in want]
    with pytest.raises(ValueError):
        add_rolling_features(df, order_col="volume")
    assert add_rolling_features(df, order_col="volume", block=F.col("volume") % 1 + F.floor(F.col("volume") / 40)).count() == 500


def test_split_plan_reads_and_shuffles_the_input_once(spark):
    """One scan, one shuffle of all rows, no job while the plan is built."""
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select(
        "l_returnflag", "l_shipdate", "l_orderkey", "l_quantity", "l_extendedprice")
    sc.setJobGroup("building", "plan")
    out = add_rolling_features(df, partition_cols=("l_returnflag",), order_col="l_shipdate",
                               tie_breaker=("l_orderkey",), volume_col="l_quantity",
                               price_col="l_extendedprice")
    assert list(tracker.getJobIdsForGroup("building")) == []
    sc.setLocalProperty("spark.jobGroup.id", None)
    out.write.format("noop").mode("overwrite").save()
    import contextlib
    import io
    buf = io.StringIO()
    out.collect()
    with contextlib.redirect_stdout(buf):
        out.explain("simple")
    final = buf.getvalue().split("+- == Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1
    assert final.count("ReusedExchange") == 1
    shuffles = [x for x in final.splitlines() if "Exchange hashpartitioning" in x and "ReusedExchange" not in x]
    assert len(shuffles) == 2                             # all rows; the edges


def test_global_window_without_key_is_split_too(spark):
    rows = [("X", d, i, float(i % 7)) for i, d in enumerate(_dates(200))]
    df = spark.createDataFrame(rows, SCHEMA)
    single = _sorted(add_rolling_features(df, partition_cols=(), block=None))
    split = _sorted(add_rolling_features(df, partition_cols=(), block="month"))
    assert single == split
