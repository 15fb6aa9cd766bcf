"""Structured Streaming entry points."""

from intake.streaming.feed import ingest_stream, stream_feed  # noqa: F401
from intake.streaming.feeder import feeder_stream  # noqa: F401
