"""Operators of a training-data pipeline over document tables.

Each module holds one operator with its own interface; ``queries.py`` wraps
them as registered queries and ``oracle.py`` holds the DuckDB SQL for those
that SQL can express. Nothing outside this package imports it.
"""
