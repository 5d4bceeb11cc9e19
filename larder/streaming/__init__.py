"""Feeding a stream of feature rows into a feature table."""

from larder.streaming.sink import latest_per_key, upsert_batch_writer

__all__ = ["latest_per_key", "upsert_batch_writer"]
