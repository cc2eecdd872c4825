"""Whole transforms from raw inputs to published documents, and the query catalog."""
