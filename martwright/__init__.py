"""Retail star-schema analytics written as plain Spark DataFrame functions."""
