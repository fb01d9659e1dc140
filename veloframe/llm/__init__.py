"""Operators of a training-data pipeline over ``documents``, ``pages`` and ``embeddings``.

Nothing outside this package imports it. Each module holds one operator with
its own interface; ``queries`` derives the registered digests from them.
"""
