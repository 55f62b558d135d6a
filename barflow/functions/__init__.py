"""Column-level functions (built-in Spark expressions only, no UDFs)."""

from barflow.functions.casts import (
    legacy_int,
    normalise_date,
    safe_float,
    strip_ws,
    symbol_from_path,
)

__all__ = ["legacy_int", "normalise_date", "safe_float", "strip_ws", "symbol_from_path"]
