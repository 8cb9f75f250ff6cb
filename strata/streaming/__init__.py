"""Micro-batch enrichment with Structured Streaming."""
