"""Delimited text sinks."""
