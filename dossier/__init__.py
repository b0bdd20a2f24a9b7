"""Filings to checked event tables, as Spark operators."""
