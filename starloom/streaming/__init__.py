"""Streaming adapters (micro-batch merges via foreachBatch)."""
