"""Operators of a training-data pipeline (one module each) and their queries.

Nothing else in the library imports this subpackage; ``__spark_entry__``
adds its queries only where it can be imported.
"""
