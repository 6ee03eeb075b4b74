"""Table builders, reports and jobs composed from the operators."""
