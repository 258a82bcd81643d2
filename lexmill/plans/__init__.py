"""Whole flows and the query catalog."""
