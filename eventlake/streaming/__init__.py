"""Structured Streaming: processors, query runs, progress metrics."""
