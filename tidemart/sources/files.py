"""File sources (SRC9, SRC10): JSON-lines records and weight dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemart.operators.scoring import read_weight_file

__all__ = ["read_json_lines", "read_weight_file", "read_parquet"]


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str,
                    corrupt_col: str | None = None) -> DataFrame:
    """SRC10: JSON-lines files -> typed records (no schema inference; files split across tasks).

    With ``corrupt_col`` unparsable lines are kept with their text in that
    column (add it to the schema as a string) instead of failing the read.
    """
    reader = spark.read.schema(schema)
    if corrupt_col:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
    return reader.json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet read; pushdown and pruning by Catalyst, split sizes by the session (``spark.sql.files.*``)."""
    return spark.read.parquet(path)
