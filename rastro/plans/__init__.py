"""Pipelines: the daily analysis, the star schema and the queries on it."""
