"""Operators: DataFrame -> DataFrame transformations, generic in column names."""
