"""Turnstone operators."""
