"""Operators of a large-scale training-data pipeline.

Nothing else in the package imports this subpackage; ``__spark_entry__.py``
adds its queries only if it can be imported.
"""
