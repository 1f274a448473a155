"""Readers: driver tables, tag rules, condition strings, business sources."""
