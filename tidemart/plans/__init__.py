"""Driver queries: the reference's jobs re-expressed over the given tables.

Each query is a function ``(spark, sf_dir) -> DataFrame`` registered with a
DuckDB SQL oracle where one exists (see :mod:`tidemart.plans.registry`).
"""

from tidemart.plans import dims, facts, logs, scalars, tags, windows  # noqa: F401  (register)
from tidemart.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
