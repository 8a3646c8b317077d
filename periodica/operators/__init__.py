"""Relational building blocks over DataFrames.

No helper collects data or forces a broadcast: join strategies are left to the
size estimates of Catalyst and to adaptive execution, which also splits skewed
partitions. Helpers that need an order within a key first reduce the key to one
row per calendar day, or use a top-1 window, which Spark trims before shuffling.
"""
