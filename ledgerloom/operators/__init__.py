"""Operators of the registry analytics library."""
