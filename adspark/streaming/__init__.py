"""Structured Streaming forms of the counter tables (K1, K2)."""
