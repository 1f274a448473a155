"""Tag jobs run per micro-batch (Structured Streaming foreachBatch upsert)."""
