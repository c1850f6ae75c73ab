"""Operators put together: the billing pipeline, model comparison, and the registered queries."""
