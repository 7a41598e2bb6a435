"""Composite products assembled from operators."""
