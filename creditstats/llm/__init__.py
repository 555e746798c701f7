"""Operators for large-scale training-data pipelines.

Each module holds one operator with its general interface; `queries.py`
holds the thin registered queries and `oracles.py` their SQL. Nothing else
in the library imports this subpackage.
"""
