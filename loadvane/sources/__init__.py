"""Readers of landed documents and staged tables, and their writers."""
