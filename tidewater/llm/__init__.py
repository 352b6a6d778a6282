"""Operators of a training-data pipeline over ``documents`` and ``pages``.

Nothing else in the package imports this subpackage. Each operator lives in a
module of its own with a general interface; ``queries`` holds the thin
``opN_<name>`` queries and their DuckDB SQL.
"""
