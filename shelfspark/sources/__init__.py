"""Readers for tables and feeds."""
