"""Structured Streaming forms of the incremental pipeline (STM-1..5)."""
