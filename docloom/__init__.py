"""Document evidence and retrieval on Spark."""
