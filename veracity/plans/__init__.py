"""Fixture mappings and the registered query catalog."""
