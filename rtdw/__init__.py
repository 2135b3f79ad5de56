"""Layered shop warehouse on Spark: change records and application logs in, facts, dimensions and window reports out.

Every operator takes and returns a DataFrame. See README.md for a tour.
"""
