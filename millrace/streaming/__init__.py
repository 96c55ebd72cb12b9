"""Mappings over streams of rows."""
