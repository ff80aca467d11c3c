"""Operators of a training-data pipeline: packing, deduplication, mixing, filtering, sharding, search.

Every operator is a function on DataFrames in a module of its own; ``queries`` registers one
query for each, ``kernels`` holds the array code that runs inside tasks.
"""
