"""Declarations: source tables, scopes, windows, and the stand-in tables of the queries."""
