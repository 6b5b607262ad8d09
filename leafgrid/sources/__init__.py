"""Readers, schemas and the normalisation of stored profiles."""
