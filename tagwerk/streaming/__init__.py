"""Structured Streaming trigger for the full refresh."""

from .trigger import matching_messages, start_refresh_stream

__all__ = ["matching_messages", "start_refresh_stream"]
