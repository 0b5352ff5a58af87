"""Lakehouse jobs for securities-depository data, written as plain Spark jobs."""
