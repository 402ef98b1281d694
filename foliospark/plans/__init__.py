"""foliospark.plans."""
