"""Functions of the registry analytics library."""
