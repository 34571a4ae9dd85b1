"""Operators: DataFrame in, DataFrame out, for every series in one job."""
