"""wordspace: skip-gram negative-sampling word embeddings as Spark DataFrame plans."""

__all__ = ["session", "sources", "functions", "operators", "plans"]
