"""eventlake - change-data and event-stream analytics as plain PySpark transforms."""

__version__ = "0.1.0"
