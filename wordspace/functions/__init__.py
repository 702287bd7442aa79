"""wordspace.functions."""
