"""A2-A5 metrics; F4/F5/X9/X10 score guard; U1 combine; A6 reconcile; L1 preview."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from barflow.operators.combine import combine_assets, reconcile_counts
from barflow.operators.metrics import regression_metrics
from barflow.operators.preview import preview
from barflow.operators.score import score_guard


def test_regression_metrics_against_numpy(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 1000, 500)
    p = y + rng.normal(0, 50, 500)
    df = spark.createDataFrame([("stock", int(a), float(b)) for a, b in zip(y, p)],
                               "asset_class string, volume int, prediction double")
    m = regression_metrics(df).first()
    err = y - p
    assert m["n"] == 500
    assert m["mae"] == pytest.approx(np.abs(err).mean())
    assert m["mse"] == pytest.approx((err ** 2).mean())
    assert m["rmse"] == pytest.approx(math.sqrt((err ** 2).mean()))
    r2 = 1 - (err ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert m["r2"] == pytest.approx(r2)
    s = regression_metrics(df, scale=100).first()
    assert s["mae"] == pytest.approx(m["mae"], abs=0.01)
    assert s["r2"] == pytest.approx(m["r2"], abs=1e-4)


def test_r2_is_null_for_constant_label(spark):
    df = spark.createDataFrame([("etf", 5, 4.0), ("etf", 5, 6.0)],
                               "asset_class string, volume int, prediction double")
    assert regression_metrics(df).first()["r2"] is None


def test_score_guard_probes(spark):
    preds = [float("nan"), -0.5, -3.2, 7.9, None, float("inf")]
    df = spark.createDataFrame([("stock", 10.0, 2.0, p) for p in preds],
                               "asset_class string, vol_moving_avg double, "
                               "adj_close_rolling_med double, prediction double")
    out = score_guard(df).collect()
    assert [r["status"] for r in out] == ["invalid_output", "ok", "negative", "ok",
                                          "invalid_output", "invalid_output"]
    assert [r["predicted_volume"] for r in out] == [None, 0, None, 7, None, None]
    assert out[3]["message"] == "The predicted stock volume given (10.0, 2.0) is 7."


def test_score_guard_rejects_bad_inputs(spark):
    df = spark.createDataFrame([("etf", float("nan"), 2.0, 5.0), ("etf", None, 2.0, 5.0),
                                ("etf", 1.0, float("-inf"), 5.0)],
                               "asset_class string, vol_moving_avg double, "
                               "adj_close_rolling_med double, prediction double")
    assert {r["status"] for r in score_guard(df).collect()} == {"invalid_input"}


def test_score_guard_takes_text_and_names_the_numbers(spark):
    cases = [("1.15", 5.0, "ok", "(1.15, 2.0) is 5"), ("0.29", 5.0, "ok", "(0.29, 2.0) is 5"),
             ("-0.001", 5.0, "ok", "(-0.001, 2.0)"), ("12345678.25", 5.0, "ok", "(12345678.25, 2.0)"),
             ("100000000", 5.0, "ok", "(100000000.0, 2.0)"), ("abc", 5.0, "invalid_input", "Invalid input."),
             ("", 5.0, "invalid_input", "Invalid input."), ("NaN", 5.0, "invalid_input", "Invalid input."),
             ("1", 1e30, "invalid_output", "Invalid Output."), ("1", -1e30, "negative", "Invalid Output."),
             ("1", -0.999, "ok", "is 0."), ("1", -1.0, "negative", "Invalid Output.")]
    df = spark.createDataFrame([("etf", a, 2.0, p) for a, p, *_ in cases],
                               "asset_class string, vol_moving_avg string, "
                               "adj_close_rolling_med double, prediction double")
    for r, (_, _, status, part) in zip(score_guard(df).collect(), cases):
        assert r["status"] == status and part in r["message"]
        assert (r["predicted_volume"] is not None) == (status == "ok")
        assert "etfs" in r["message"] or status != "ok"


def test_scaled_metrics_far_beyond_a_bigint(spark):
    rows = [("stock", 2_000_000_000 + i, 1.0) for i in range(5)] + [("etf", 50_000_000 + i, 0.0) for i in range(4000)]
    df = spark.createDataFrame(rows, "asset_class string, volume int, prediction double")
    got = {r["asset_class"]: r for r in regression_metrics(df, scale=100).collect()}
    for cls in ("stock", "etf"):
        y = [v for c, v, _ in rows if c == cls]
        p = [v for c, _, v in rows if c == cls]
        assert got[cls]["mse"] == pytest.approx(sum((a - b) ** 2 for a, b in zip(y, p)) / len(y), rel=1e-12)
        assert got[cls]["mae"] == pytest.approx(sum(abs(a - b) for a, b in zip(y, p)) / len(y), rel=1e-12)


def test_both_sinks_overwrite_alike_under_either_session_mode(spark, tmp_dir):
    from barflow.sinks.parquet import write_dataset
    both = spark.createDataFrame([("stock", 1), ("etf", 2), ("etf", 3), ("bond", 4)], "asset_class string, volume int")
    for mode in ("static", "dynamic"):
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        try:
            a, b = f"{tmp_dir}/{mode}-prices", f"{tmp_dir}/{mode}-features"
            first = {r["dataset"]: r for r in reconcile_counts(spark, both, a).collect()}
            assert first["<other>"]["ok"] and first["<other>"]["expected_rows"] == 1
            write_dataset(both, b)
            again = both.where("asset_class = 'stock'")
            assert [r["ok"] for r in reconcile_counts(spark, again, a).collect()] == [True]
            write_dataset(again, b)
            assert spark.read.parquet(a).count() == spark.read.parquet(b).count() == 4
        finally:
            spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_combine_by_name_and_schema_mismatch(spark):
    a = spark.createDataFrame([("A", 1)], "symbol string, volume int")
    b = spark.createDataFrame([(2, "B")], "volume int, symbol string")
    out = combine_assets(a, b).orderBy("symbol").collect()
    assert [(r["symbol"], r["volume"], r["asset_class"]) for r in out] == \
        [("A", 1, "stock"), ("B", 2, "etf")]
    c = spark.createDataFrame([("C", 1.0)], "symbol string, price double")
    with pytest.raises(Exception):
        combine_assets(a, c).collect()


def test_reconcile_counts(spark, tmp_dir):
    a = spark.createDataFrame([("A", 1)] * 3, "symbol string, volume int")
    b = spark.createDataFrame([("B", 2)] * 2, "symbol string, volume int")
    out = {r["dataset"]: r for r in reconcile_counts(spark, combine_assets(a, b),
                                                     path=f"{tmp_dir}/p").collect()}
    assert out["stock"]["expected_rows"] == 3 and out["stock"]["actual_rows"] == 3
    assert out["etf"]["ok"] and out["stock"]["ok"]
    # re-run: overwrite, not append
    reconcile_counts(spark, combine_assets(a, b), path=f"{tmp_dir}/p").collect()
    assert spark.read.parquet(f"{tmp_dir}/p").count() == 5


def test_preview_is_ordered_top_k(spark):
    df = spark.createDataFrame([(f"S{i:02d}", i) for i in range(30)][::-1], "s string, v int")
    assert [r["s"] for r in preview(df, 3, ["s"]).collect()] == ["S00", "S01", "S02"]


def test_recommended_conf_scales_with_data():
    from barflow.plans.tuning import recommended_conf

    small = recommended_conf(10 << 30, total_cores=64)
    big = recommended_conf(100 << 40, total_cores=8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 64
    assert int(big["spark.sql.shuffle.partitions"]) % 8000 == 0
    assert int(big["spark.sql.shuffle.partitions"]) * (512 << 20) >= 100 << 40
    assert int(big["spark.sql.shuffle.partitions"]) <= 250_000


def test_the_guard_names_a_missing_class_and_works_the_status_out_once(spark):
    df = spark.createDataFrame([(None, 1.5, 2.0, 5.0)], "asset_class string, vol_moving_avg double, "
                               "adj_close_rolling_med double, prediction double")
    out = score_guard(df)
    assert out.columns[-3:] == ["predicted_volume", "status", "message"]
    assert out.first()["message"] == "The predicted null volume given (1.5, 2.0) is 5."
    text = df.withColumn("vol_moving_avg", F.col("vol_moving_avg").cast("string"))
    plan = score_guard(text)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("THEN invalid_output") <= 2 and "format_string" not in plan


def test_the_guard_reads_and_writes_a_number_once(spark, tmp_dir):
    rows = [("stock", t, p, 5.0) for t in ("1.15", "abc", "", None, "NaN", "1e20", "0.0001", "12345678.25", "-0.5")
            for p in (2.0, None, 12345678.5, float("inf"), 0.002)]
    df = spark.createDataFrame(rows, "asset_class string, vol_moving_avg string, adj_close_rolling_med double, "
                               "prediction double")
    df.write.parquet(f"{tmp_dir}/requests")
    out = score_guard(spark.read.parquet(f"{tmp_dir}/requests"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("as double)") == 1 and plan.count("_text_0") > 1
    got = {(r["vol_moving_avg"], r["adj_close_rolling_med"]): r["message"] for r in out.collect()}
    assert got["12345678.25", 12345678.5].endswith("given (12345678.25, 12345678.5) is 5.")
    assert got["0.0001", 0.002].endswith("given (1.0E-4, 0.002) is 5.")
    assert sum(m.startswith("The predicted") for m in got.values()) == 5 * 3
