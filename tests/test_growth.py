"""What must not grow with batches, symbols or input beyond its share."""

import glob
import os

from pyspark.sql import functions as F

from barflow.operators import model as M
from barflow.operators.joins import input_bytes
from barflow.plans import catalog as C
from barflow.session import LISTING, few_listing_tasks
from barflow.sources import fixtures as fx
from barflow.sources.csv_prices import write_flat_price_csv
from barflow.streaming.incremental import ingest_prices_incremental

SF = "/root/testdata/sf0.001"
HEADER = "Date,Open,High,Low,Close,Adj Close,Volume\n"


def land(d, n):
    os.makedirs(d)
    for i in range(n):
        with open(f"{d}/T{i}.csv", "w") as f:
            f.write(HEADER + "2020-01-02,1,1,1,1,1,5\n2020-02-03,1,1,1,1,1,5\n")


def test_meta_is_derived_once_for_all_micro_batches(spark, tmp_dir):
    land(f"{tmp_dir}/in", 4)
    derived = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def name(symbol):
        derived.add(1)
        return f"name of {symbol}"

    meta = spark.createDataFrame([("T0",)], "symbol string").withColumn("security_name", name.asNondeterministic()("symbol"))
    got = ingest_prices_incremental(spark, f"{tmp_dir}/in", meta, f"{tmp_dir}/out", f"{tmp_dir}/ck", files_per_trigger=1)
    assert got == {"batches": 4, "rows": 8} and derived.value == 1
    assert spark.read.parquet(f"{tmp_dir}/out").where("security_name = 'name of T0'").count() == 2


def test_a_batch_writes_one_file_a_month(spark, tmp_dir):
    land(f"{tmp_dir}/in", 12)
    meta = spark.createDataFrame([("T0", "Zero")], "symbol string, security_name string")
    got = ingest_prices_incremental(spark, f"{tmp_dir}/in", meta, f"{tmp_dir}/out", f"{tmp_dir}/ck", None, by_month=True)
    assert got == {"batches": 1, "rows": 24} and len(glob.glob(f"{tmp_dir}/out/month=*/*.parquet")) == 2


def test_many_paths_are_listed_by_few_tasks(spark):
    before = spark.conf.get(LISTING)
    with few_listing_tasks(spark):
        assert int(spark.conf.get(LISTING)) == 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(LISTING) == before


def test_input_size_is_that_of_the_files(spark):
    size = os.path.getsize(f"{SF}/lineitem.parquet")
    both = size + os.path.getsize(f"{SF}/part.parquet")
    assert 0.2 * size < input_bytes(fx.stock_bars(spark, SF)) <= size
    assert input_bytes(fx.etf_bars(spark, SF)) <= both          # no product of a join's sides
    assert input_bytes(spark.range(5).select("id").checkpoint()) < 1 << 20


def test_flat_files_of_several_symbols(spark, tmp_dir):
    bars = fx.stock_bars(spark, SF)
    write_flat_price_csv(bars, f"{tmp_dir}/flat", suffix=".US")
    names = {os.path.basename(p) for p in glob.glob(f"{tmp_dir}/flat/*.csv")}
    assert names == {f"{r.symbol}.US.csv" for r in bars.select("symbol").distinct().collect()}
    assert not os.path.exists(f"{tmp_dir}/flat/_staged")


def test_small_training_sets_are_fitted_in_few_tasks(spark):
    df = spark.range(1000).repartition(6)
    assert M._in_few_tasks(df, 1000).rdd.getNumPartitions() == 1
    assert M._in_few_tasks(df, 120_000).rdd.getNumPartitions() == 3


def test_scoring_derives_the_features_once(spark, monkeypatch):
    calls, real, fit = [], C._combined_features, C.train_volume_model
    monkeypatch.setattr(C, "_combined_features", lambda *a: calls.append(1) or real(*a))
    monkeypatch.setattr(C, "train_volume_model", lambda train, n, p: fit(train, 2, M.BoostParams(max_depth=2)))
    assert C.q_score_volume(spark, SF).where("NOT scored").isEmpty() and len(calls) == 1


def test_ticks_are_windowed_by_day(spark, capsys):
    C.q_rolling_ticks_by_flag(spark, SF).explain("extended")
    out = capsys.readouterr().out
    assert "date_trunc(day" in out and "date_trunc(year" not in out
