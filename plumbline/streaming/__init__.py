"""Judging files as they arrive."""
