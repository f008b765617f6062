"""Readers for the landed feeds and the adapter over commerce tables."""
