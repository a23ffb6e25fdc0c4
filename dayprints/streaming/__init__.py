"""Structured Streaming forms of the slot aggregates and of the online clustering."""
