"""Training-data pipeline operators.

Each module holds one operator with a general interface and the thin query that
applies it to the shared tables.  Nothing outside this package imports it.
"""
