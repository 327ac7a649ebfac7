"""Incremental loads: high-water marks, skip-existing merges, streaming upserts."""
