"""Readers and views that produce the nine retail tables."""
