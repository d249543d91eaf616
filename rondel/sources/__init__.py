"""Readers, stream sources and table writers."""
