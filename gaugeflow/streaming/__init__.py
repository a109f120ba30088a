"""Structured Streaming: ingestion sinks, keyed logs and keyed state."""
