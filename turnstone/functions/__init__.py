"""Turnstone functions."""
