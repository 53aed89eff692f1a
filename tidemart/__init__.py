"""tidemart: a Spark-native real-time retail warehouse.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
Spark SQL expressions, joins, aggregates and windows, so Catalyst plans it
and the same code runs on batch tables and (where the meaning allows) on
Structured Streaming.
"""

__version__ = "0.1.0"
