"""Tillwise: retail decision tables as Spark DataFrame jobs."""
