"""Analytic sub-operators: each takes and returns a DataFrame (or a Column rule)."""
