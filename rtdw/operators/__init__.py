"""Warehouse operators, each from DataFrame to DataFrame."""
