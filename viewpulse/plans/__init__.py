"""Operators put together: the nightly run and the registered queries."""
