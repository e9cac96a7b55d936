"""Whole queries and jobs assembled from the operators."""
