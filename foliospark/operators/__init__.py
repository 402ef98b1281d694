"""foliospark.operators."""
