"""Operators of a training-data pipeline over document, page and conversation tables.

Nothing else in the library imports this subpackage; ``__spark_entry__.py`` adds
its queries only when it can be imported.
"""
