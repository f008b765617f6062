"""Reusable DataFrame steps."""
