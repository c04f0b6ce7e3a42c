"""Structured Streaming forms of the panel's incremental passes."""
