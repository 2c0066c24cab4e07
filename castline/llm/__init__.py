"""Operators for large training-text pipelines (thirteen operators and their queries).

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds
its queries only when it can be imported.
"""
