"""Structured Streaming entry points (incremental append landing)."""

from rankforge.streaming.landing import land_available, start_landing  # noqa: F401
