"""Operators: DataFrame in, DataFrame out, nothing is executed."""
