"""Readers, writers, listings and names."""
