"""Operators that take and return DataFrames and carry the slice key with them."""
