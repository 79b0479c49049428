"""Whole flows assembled from the operators."""
