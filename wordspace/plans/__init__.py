"""wordspace.plans."""
