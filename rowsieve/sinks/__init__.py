"""Batch sinks."""
