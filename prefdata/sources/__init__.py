"""Readers, writers and the schemas they use."""
