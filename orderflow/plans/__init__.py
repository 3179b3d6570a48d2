"""Registered queries and their DuckDB oracle SQL."""
