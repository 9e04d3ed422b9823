"""Structured Streaming: incremental file loads, deduplication, 30-minute bars."""
