"""JDBC reads (SRC11) with optional UPPER_UNDERSCORE -> lowerCamel column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

__all__ = ["lower_camel", "rename_lower_camel", "read_jdbc_query"]


def lower_camel(name: str) -> str:
    """'ORDER_ID' / 'order_id' -> 'orderId' (first word lower-case, later words capitalised)."""
    parts = [p for p in name.split("_") if p]
    if not parts:
        return name
    return parts[0].lower() + "".join(p[:1].upper() + p[1:].lower() for p in parts[1:])


def rename_lower_camel(df: DataFrame) -> DataFrame:
    """Rename all columns (metadata only, no data movement)."""
    return df.toDF(*[lower_camel(c) for c in df.columns])


def read_jdbc_query(spark: SparkSession, url: str, query: str, properties: dict | None = None,
                    underscore_to_camel: bool = False, partition: dict | None = None) -> DataFrame:
    """SRC11: a SQL query over JDBC. ``partition`` = {column, lowerBound, upperBound, numPartitions}
    reads in parallel ranges instead of one connection."""
    reader = spark.read.format("jdbc").option("url", url)
    if partition:
        reader = reader.option("dbtable", f"({query}) q")
        for k, v in partition.items():
            reader = reader.option("partitionColumn" if k == "column" else k, str(v))
    else:
        reader = reader.option("query", query)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    df = reader.load()
    return rename_lower_camel(df) if underscore_to_camel else df
