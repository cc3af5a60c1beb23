"""Incremental enrichment as a resumable Structured Streaming job."""
