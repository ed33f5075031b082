"""Pipelines of operators."""
