"""Named outputs: chains of operators over the base tables."""
