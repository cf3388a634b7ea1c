"""Structured Streaming: static enrichment, sinks and query lifecycle."""
