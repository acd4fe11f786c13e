"""Shaping of rows for destinations, and replay-safe micro-batch writers."""
