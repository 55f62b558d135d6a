"""Driver contract + oracle on sf0.001 + the end-to-end job."""

import hashlib
import json
import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as E
from barflow.plans.daily_job import committed_prices, ingest_new_files, land_fixture_csv, run_job

SF = "/root/testdata/sf0.001"
TABLES = ("lineitem", "part", "supplier", "orders", "customer", "nation", "region")
# the training-data queries have tests of their own
OWN_TESTS = re.compile(r"op\d+_|pipeline$")
SLOW = {"features_incremental", "csv_ingest", "reconcile_counts", "daily_job_features", "train_eval", "score_volume", "csv_ingest_flat"}


def _digest(rows):
    def norm(v):
        if v is None:
            return None
        if isinstance(v, float):
            return "NaN" if math.isnan(v) else repr(v)
        return str(v)
    return hashlib.sha256("\n".join(sorted(json.dumps([norm(x) for x in r]) for r in rows))
                          .encode()).hexdigest()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"vol_moving_avg", "adj_close_rolling_med", "security_name"} <= set(df.columns)


def test_every_query_has_oracle_or_is_ml():
    q, o = E.queries(), E.oracle_sql()
    assert all(OWN_TESTS.match(k) for k in set(q) - set(o))
    assert set(o) <= set(q)


@pytest.mark.parametrize("key", sorted(set(E.oracle_sql()) - SLOW))
def test_query_matches_duckdb(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[key](spark, SF)
    cols = sorted(df.columns)
    srows = [tuple(r[c] for c in cols) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[key])
    assert sorted(rel.columns) == cols
    drows = rel.select(*[f'"{c}"' for c in cols]).fetchall()
    assert len(srows) == len(drows)
    assert _digest(srows) == _digest(drows)


def test_run_job_end_to_end_and_idempotent(spark, tmp_dir):
    cfg = land_fixture_csv(spark, SF, tmp_dir)
    cfg = cfg.__class__(**{**cfg.__dict__, "tree_grid": (2, 4), "cv_folds": 2})
    s1 = run_job(spark, cfg)
    assert all(r["ok"] for r in s1["reconcile"])
    n_prices = spark.read.parquet(cfg.prices_path).count()
    assert n_prices == sum(r["actual_rows"] for r in s1["reconcile"])
    assert s1["features_rows"] == n_prices
    assert {m["asset_class"] for m in s1["metrics"]} == {"stock", "etf"}
    s2 = run_job(spark, cfg, train=False)
    assert spark.read.parquet(cfg.prices_path).count() == n_prices
    assert s2["features_rows"] == n_prices
    assert spark.read.parquet(cfg.metrics_path).count() == 2
    curves = spark.read.parquet(cfg.curves_path).groupBy("asset_class").count().collect()
    assert {r["asset_class"]: r["count"] for r in curves} == {m["asset_class"]: m["n_trees"] for m in s1["metrics"]}


def test_incremental_job_reads_each_file_once(spark, tmp_dir):
    cfg = land_fixture_csv(spark, SF, tmp_dir)
    cfg = cfg.__class__(**{**cfg.__dict__, "incremental": True})
    first = run_job(spark, cfg, train=False)
    assert sum(v["rows"] for v in first["ingested"].values()) == first["features_rows"]
    again = run_job(spark, cfg, train=False)
    assert all(v["rows"] == 0 for v in again["ingested"].values())
    assert again["features_rows"] == first["features_rows"]


def test_a_symbol_named_twice_gives_repeatable_features(spark, tmp_dir):
    cfg = land_fixture_csv(spark, SF, tmp_dir)
    twice = spark.read.option("header", True).csv(cfg.meta_file)
    twice.unionByName(twice.selectExpr("Symbol", "concat(`Security Name`, ' B') AS `Security Name`")).write.option(
        "header", True).csv(f"{tmp_dir}/meta2")
    cfg = cfg.__class__(**{**cfg.__dict__, "meta_file": f"{tmp_dir}/meta2"})
    runs = []
    for parts in (3, 7):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        run_job(spark, cfg, train=False)
        runs.append(_digest([tuple(r) for r in spark.read.parquet(cfg.features_path).collect()]))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert runs[0] == runs[1]


def test_job_on_flat_per_symbol_files(spark, tmp_dir):
    import os

    from barflow.plans.daily_job import main

    header = "Date,Open,High,Low,Close,Adj Close,Volume\n"
    for cls, files in {"s": {"AAA.csv": 40, "BRK.B.csv": 35}, "e": {"EEE.csv": 31}}.items():
        os.makedirs(f"{tmp_dir}/{cls}")
        for name, n in files.items():
            with open(f"{tmp_dir}/{cls}/{name}", "w") as f:
                f.write(header + "".join(f"2020-01-{1 + i % 28:02d},1,2,0.5,1.5,{i}.5,{i * 10}\n"
                                         if i < 28 else
                                         f"2020-02-{i - 27:02d},1,2,0.5,1.5,{i}.5,{i * 10}\n"
                                         for i in range(n)))
    with open(f"{tmp_dir}/meta.csv", "w") as f:
        f.write("Symbol,Security Name\nAAA,Triple A\nBRK,Berk\n")
    summary = main(["--root", f"{tmp_dir}/out", "--stocks", f"{tmp_dir}/s",
                    "--etfs", f"{tmp_dir}/e", "--meta", f"{tmp_dir}/meta.csv", "--no-train"])
    assert {r["dataset"]: r["actual_rows"] for r in summary["reconcile"]} == {"stock": 75, "etf": 31}
    feats = spark.read.parquet(f"{tmp_dir}/out/features")
    assert {r[0] for r in feats.select("symbol").distinct().collect()} == {"AAA", "BRK", "EEE"}
    last = feats.where("symbol = 'AAA' AND date = '2020-02-12'").first()
    assert last["vol_moving_avg"] == sum(i * 10 for i in range(10, 40)) / 30


def test_files_of_a_batch_killed_before_its_commit_are_no_rows(spark, tmp_dir):
    cfg = land_fixture_csv(spark, SF, tmp_dir)
    cfg = cfg.__class__(**{**cfg.__dict__, "incremental": True})
    ingest_new_files(spark, cfg)
    want = sorted(map(str, committed_prices(spark, cfg).collect()))
    assert len(want) == spark.read.parquet(cfg.prices_path).count()
    # as a kill between the file write and the commit leaves it: the last batch's files are there, in no log
    for cls in ("stock", "etf"):
        for log in (f"{cfg.checkpoint_path}/{cls}/commits", f"{cfg.prices_path}/asset_class={cls}/_spark_metadata"):
            last = max((f for f in os.listdir(log) if f.isdigit()), key=int)
            for name in (last, f".{last}.crc"):
                if os.path.exists(f"{log}/{name}"):
                    os.remove(f"{log}/{name}")
    assert spark.read.parquet(cfg.prices_path).count() == len(want)      # the parent folder shows them all
    ingest_new_files(spark, cfg)          # the batch without a commit runs again
    assert spark.read.parquet(cfg.prices_path).count() > len(want)
    assert sorted(map(str, committed_prices(spark, cfg).collect())) == want
    assert run_job(spark, cfg, train=False)["features_rows"] == len(want)
