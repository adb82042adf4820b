"""Pipelines and the catalogue of queries over them."""
