"""Input columns named like the operators' helper columns pass through unchanged."""

import pytest
from pyspark.sql import functions as F

from barflow.operators import model as M
from barflow.operators.prepare import sample_split
from barflow.operators.rolling import add_rolling_features
from barflow.operators.score import score_volume


def rows(df, columns):
    return sorted(map(str, df.select(columns).collect()))


@pytest.fixture(scope="module")
def bars(spark):
    return spark.range(300).selectExpr(
        "concat('S', id % 3) AS symbol", "date_format(date_add('2020-01-01', cast(id AS int)), 'yyyy-MM-dd') AS date",
        "cast(id * 7 % 31 AS int) AS volume", "cast(id * 5 % 17 AS float) AS adj_close")


def named(df, *names):
    return df.withColumns({n: F.concat(F.lit(n), F.col("date")) for n in names})


def test_window_keeps_columns_of_its_helpers_names(bars):
    clash = named(bars, "_block", "_PLACE", "_rows")
    out = add_rolling_features(clash, window_rows=7, block="month")
    assert out.columns == [*clash.columns, "vol_moving_avg", "adj_close_rolling_med"]
    assert rows(out, clash.columns) == rows(clash, clash.columns)
    plain = add_rolling_features(bars, window_rows=7, block=None)
    assert rows(out, plain.columns) == rows(plain, plain.columns)


@pytest.mark.parametrize("approx", [False, True])
def test_sample_keeps_columns_of_its_helpers_names(bars, approx):
    clash = named(bars, "_h", "_k", "_u", "_first")
    out = sample_split(clash, approx=approx)
    assert out.columns == [*clash.columns, "split"]
    plain = sample_split(bars, approx=approx)
    assert rows(out, plain.columns) == rows(plain, plain.columns)
    assert out.where("_h = concat('_h', date) AND _k = concat('_k', date)").count() == out.count() > 0


def test_score_keeps_columns_of_its_helpers_names(bars):
    train = bars.selectExpr("cast(volume AS double) AS vol_moving_avg",
                            "cast(adj_close AS double) AS adj_close_rolling_med", "volume")
    models = {"stock": M.train_volume_model(train, 2)}
    asked = named(train.selectExpr("'stock' AS asset_class", "vol_moving_avg", "adj_close_rolling_med",
                                   "cast(volume AS string) AS date"), "features", "_given_0", "_prediction_0")
    out = score_volume(asked, models)
    assert out.columns[:len(asked.columns)] == asked.columns
    assert rows(out, asked.columns) == rows(asked, asked.columns)
    plain = score_volume(asked.drop("features", "_given_0", "_prediction_0"), models)
    assert rows(out, plain.columns) == rows(plain, plain.columns)
