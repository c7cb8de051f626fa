"""Readers, writers and saved tables."""
