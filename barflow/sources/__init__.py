"""Readers: landed price CSVs, symbol metadata, derived test fixtures."""

from barflow.sources.csv_prices import (
    clean_types,
    ingest_prices,
    read_price_csv,
    read_symbol_meta,
    write_price_csv,
)

__all__ = ["clean_types", "ingest_prices", "read_price_csv", "read_symbol_meta",
           "write_price_csv"]
