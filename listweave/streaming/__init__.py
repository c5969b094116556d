"""Structured Streaming over the same state: scans, quotas, duplicates, stale work, windows."""
