"""Operators composed into jobs, plus the query registry."""
