"""foliospark.sources."""
