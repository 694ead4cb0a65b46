"""Column functions that belong to no operator."""
