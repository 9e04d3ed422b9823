"""Landed files: readers, page parsers and table files."""
