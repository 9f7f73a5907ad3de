"""Contract rules, lax coercion and masking as Spark Column expressions."""
