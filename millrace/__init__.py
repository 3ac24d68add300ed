"""millrace: feature, monitoring and corpus operators as plain Spark DataFrame functions."""

__version__ = "0.1.0"
