"""Operators put together: whole pipelines, and the registered queries."""
