"""Operators wired into layers and named queries."""
