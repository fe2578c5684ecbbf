"""Turnstone streaming."""
