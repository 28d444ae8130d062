"""Incremental loading of landed responses."""
