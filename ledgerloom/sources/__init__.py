"""Sources of the registry analytics library."""
