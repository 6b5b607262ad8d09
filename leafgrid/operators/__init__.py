"""Relational kernels: DataFrame in, DataFrame out, keyed by explicit columns."""
