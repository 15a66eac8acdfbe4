"""Metrics over one table, over grouped counts and over two tables; profiling; suggestion."""
