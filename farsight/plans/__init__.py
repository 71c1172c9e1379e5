"""Composed pipelines and the registered query catalog."""
