"""Registered queries: Spark plans over the driver tables and their DuckDB oracles."""
