"""Registered queries over the benchmark tables, with their SQL counterparts."""
