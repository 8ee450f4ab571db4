"""Ledger-style analytics written as plain Spark jobs."""
