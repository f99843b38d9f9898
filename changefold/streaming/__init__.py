"""Structured Streaming jobs: raw (bronze), silver and gold, one query per table."""
