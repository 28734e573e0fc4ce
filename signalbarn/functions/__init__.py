"""Column helpers and the two skew-safe building blocks (series and quantiles)."""
