"""Relational operators of the pipeline, one module per layer."""
