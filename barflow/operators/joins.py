"""Attach security names (left outer equi-join, USING semantics)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default size under which a join side may be broadcast. A meta table has about
# one row per listed symbol (two short strings), far below this.
DEFAULT_MAX_BROADCAST_BYTES = 256 << 20
UNKNOWN_BYTES = 1 << 60         # what the optimizer takes a frame without files for is beyond


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the frame's size, from file sizes. Runs no job."""
    plan = df._jdf.queryExecution().optimizedPlan()
    return int(str(plan.stats().sizeInBytes()))


def input_bytes(df: DataFrame) -> int:
    """The size of the files that ``df`` reads, as far as it is known. Runs no job."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(s for s in sizes if s < UNKNOWN_BYTES)


def bounded_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only behind a checked size bound.

    The size is the optimizer's estimate: the scanned files' sizes, scaled by the
    share of the columns read and taken whole through filters, so it errs upwards.
    It is read while planning; no job runs. Above ``max_bytes``, and wherever the
    estimate is unknown (then it is huge), the frame is returned as is and the
    planner chooses a shuffle join: AQE may still broadcast a side that turns out
    small, and splits skewed join keys.
    """
    return F.broadcast(df) if planned_bytes(df) <= max_bytes else df


def attach_security_name(prices: DataFrame, meta: DataFrame, key: str = "symbol",
                         name_col: str = "security_name",
                         max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Left join ``prices`` to ``meta[key, name_col]`` on ``key``.

    USING semantics: the key is emitted once, first. The meta table is *not*
    de-duplicated: a symbol listed twice fans out into two rows, as a plain
    left join does. Prices are never dropped (left outer).
    """
    m = meta.select(key, name_col)
    return prices.join(bounded_broadcast(m, max_broadcast_bytes), key, "left")
