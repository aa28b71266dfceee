"""Column-level helpers: null semantics, dates, ranking, special functions."""
