"""Structured Streaming: event-time replay, availableNow runner, keyed state."""
