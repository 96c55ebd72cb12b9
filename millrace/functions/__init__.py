"""Expressions and date formats."""
