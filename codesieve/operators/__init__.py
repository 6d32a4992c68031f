"""Table functions: each takes and returns a DataFrame."""
