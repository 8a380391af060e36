"""Plans of the registry analytics library."""
