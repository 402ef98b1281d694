"""foliospark.streaming."""
