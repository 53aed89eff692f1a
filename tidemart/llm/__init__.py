"""Operators for large-scale training-data pipelines (optional: nothing else in the library imports this subpackage).

One module per operator; ``queries.py`` registers the driver queries ``op<N>_<name>`` and their DuckDB SQL.
"""
