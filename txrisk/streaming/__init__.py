"""Structured Streaming: score raw-data message streams against the latest feature snapshots."""
