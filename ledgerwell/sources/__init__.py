"""Readers of raw line-JSON and the table store."""
