"""Readers and writers: nested API dumps, CSV tables, keyed tables."""
