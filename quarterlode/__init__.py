"""Quarterly safety-report analytics as plain Spark DataFrame functions."""
