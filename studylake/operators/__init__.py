"""Relational operators of the load, each a DataFrame -> DataFrame transformation."""
