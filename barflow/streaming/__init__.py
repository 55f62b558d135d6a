"""Structured Streaming entry points (file-stream ingest and scoring)."""

from barflow.streaming.incremental import ingest_prices_incremental, price_stream
from barflow.streaming.scoring import score_stream

__all__ = ["ingest_prices_incremental", "price_stream", "score_stream"]
