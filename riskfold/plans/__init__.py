"""Bindings of operators to tables and the query catalogue."""
