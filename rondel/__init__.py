"""rondel: match, text, graph and table-layout analytics as plain Spark DataFrame functions."""

__version__ = "0.1.0"
