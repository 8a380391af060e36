"""Streaming of the registry analytics library."""
