"""Structured Streaming: the runner, idempotent sinks, keyed state of visitors and the warehouse's jobs."""
