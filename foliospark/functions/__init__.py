"""foliospark.functions."""
