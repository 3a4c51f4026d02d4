"""Readers, writers and the views built over the test tables."""
