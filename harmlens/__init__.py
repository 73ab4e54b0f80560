"""Workplace-injury analytics as Spark DataFrame jobs."""
