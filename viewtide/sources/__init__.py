"""Readers for tables and event streams."""
