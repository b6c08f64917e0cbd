"""Streaming forms of the runs."""

from sharefold.streaming.feeds import drop_repeats, stream_feed, stream_upsert

__all__ = ["drop_repeats", "stream_feed", "stream_upsert"]
