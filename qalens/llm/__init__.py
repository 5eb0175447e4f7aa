"""Operators of a training-data pipeline over a ``documents`` table.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its queries when it is present.
Each module holds one operator with its own general interface; ``registry`` holds the thin queries.
"""
