"""Relational, windowed and table-rewrite operators on Spark DataFrames."""
