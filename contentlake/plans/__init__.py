"""Composite pipelines built from the operators."""
