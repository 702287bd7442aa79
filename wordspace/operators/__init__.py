"""wordspace.operators."""
