"""Lookups, assertions, projection and union."""
