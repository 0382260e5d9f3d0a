"""Scans: files, tables, incremental directories, rescued JSON."""
