"""Physical-plan properties the design relies on (checked via explain())."""

import contextlib
import io
import re

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_flagship_prunes_pushes_and_broadcasts(spark):
    plan = _plan(E.queries()["rolling_features"](spark, SF))
    li_schema = [s for s in re.findall(r"ReadSchema: (struct<[^\n]*>)", plan) if "l_orderkey" in s]
    assert li_schema, plan
    for unused in ("l_tax", "l_returnflag", "l_linestatus"):
        assert unused not in li_schema[0]                   # column pruning reached the scan
    assert "GreaterThan(s_acctbal,0.0)" in plan             # filter pushed into the scan
    assert "BroadcastHashJoin LeftOuter BuildRight" in plan  # meta broadcast (size-checked)
    # one shuffle for the bar aggregate, one for the window (+ the tiny meta agg)
    hash_exchanges = re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", plan)
    assert any("symbol" in h for h in hash_exchanges)
    assert len(hash_exchanges) <= 3


def test_scoring_and_guard_add_no_shuffle(spark):
    from barflow.operators.score import score_guard

    base = spark.read.parquet(f"{SF}/lineitem.parquet").selectExpr(
        "'stock' AS asset_class", "l_quantity AS vol_moving_avg",
        "l_extendedprice AS adj_close_rolling_med", "l_discount AS prediction")
    assert "Exchange" not in _plan(score_guard(base))


def test_sample_split_moves_no_rows_but_ties(spark):
    from barflow.operators.prepare import sample_split

    df = spark.read.parquet(f"{SF}/lineitem.parquet").selectExpr(
        "CAST(l_suppkey AS STRING) AS symbol", "CAST(l_orderkey AS STRING) AS date",
        "l_linenumber")
    plan = _plan(sample_split(df, checkpoint=False))
    assert "RangePartitioning" not in plan and "SinglePartition" not in plan and "Join" not in plan
    assert len(re.findall(r"Arguments: hashpartitioning", plan)) <= 1          # of the cut-offs' own keys


def test_building_the_features_runs_no_job(spark):
    """Schema reads aside: the joins decide from file sizes."""
    queries = E.queries()
    sc, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    for key, tables in (("rolling_features", 3), ("rolling_features_combined", 5)):
        sc.setJobGroup(f"build-{key}", key)
        try:
            df = queries[key](spark, SF)
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        assert len(list(tracker.getJobIdsForGroup(f"build-{key}"))) <= tables      # one schema read a table
    plan = _plan(df)
    tree = plan.split("\n\n")[0]
    assert tree.count("BroadcastHashJoin LeftOuter BuildRight") == 1             # the meta, once


def test_scratch_needs_a_shared_folder_unless_local():
    import pytest

    from barflow import session

    class Conf:
        def get(self, key, default=None):
            return "spark://host:7077" if key == "spark.master" else default

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_scratch_tables_can_be_removed(spark):
    from barflow.session import materialise, remove_path

    df, path = materialise(spark.range(10), "gone")
    assert df.count() == 10
    remove_path(spark, path)
    import os
    assert not os.path.exists(path.removeprefix("file:"))
