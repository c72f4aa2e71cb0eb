"""DataFrame operators. Each takes columns as arguments and returns a DataFrame."""
