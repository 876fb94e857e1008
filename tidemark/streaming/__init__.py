"""Structured Streaming variants of the batch dataflows."""
