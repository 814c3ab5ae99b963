"""Operators over impression frames."""
