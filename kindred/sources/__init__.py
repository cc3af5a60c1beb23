"""Readers, writers and the HTML, synthetic and vector-store sources."""
