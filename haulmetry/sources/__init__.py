"""Declared schemas, readers and sinks."""
