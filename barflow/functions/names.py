"""Names for helper columns that no input column has."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names``, lengthened where ``df`` has them (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
