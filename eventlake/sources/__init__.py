"""Readers and the shapes they deliver."""
