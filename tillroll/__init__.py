"""Layered retail analytics on Spark: raw events to star schema, marts and checks.

Every operator is a function from DataFrames to DataFrames; ``plans`` adds the reads and writes.
"""
