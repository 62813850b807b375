"""Landing files and published tables."""
