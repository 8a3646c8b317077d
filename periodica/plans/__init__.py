"""Composed jobs: each function declares one plan over table DataFrames.

``t`` arguments are mappings from table name to DataFrame.
"""
