"""wordspace.sources."""
