"""Everyday table and stream analytics as plain Spark DataFrame jobs."""
