"""Turnstone sources."""
