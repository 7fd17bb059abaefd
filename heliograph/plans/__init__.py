"""Composed plans, the driver tables' views and the query catalog."""
