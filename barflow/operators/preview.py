"""L1: deterministic preview of the first rows of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def preview(df: DataFrame, n: int = 10, order_by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows in ``order_by`` order (default: all columns).

    ``orderBy + limit`` plans as a top-k (TakeOrderedAndProject): each task keeps
    only its best ``n`` rows, so no full sort or shuffle of the table.
    The limit is the feature here (the reference shows 10 rows of meta).
    """
    cols = list(order_by) if order_by else list(df.columns)
    return df.orderBy(*cols).limit(n)
