"""Whole plans made of operators: building an index, evaluating it, and the query catalogue."""
