"""Dimension tables as parquet/managed tables (SRC12, SRC13, SNK5, SNK8-SNK10).

A dimension is one row per ``row_key`` with STRING cells. Writes are set-wise:
a batch of changes is merged cell by cell into the table, never row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.stateful import arrival_struct

__all__ = ["scan_limit", "point_get", "point_get_many", "merge_cells", "delete_keys", "table_rows",
           "create_table_if_absent", "table_exists", "list_tables", "drop_table", "drop_namespace"]


def scan_limit(dim: DataFrame, key: str, limit: int) -> DataFrame:
    """SRC12: first ``limit`` rows in row-key (text) order, key exposed as ``row_key``."""
    rk = F.col(key).cast("string")
    return dim.select(rk.alias("row_key"), *[c for c in dim.columns if c != key]).orderBy("row_key").limit(limit)


def point_get(dim: DataFrame, key: str, value) -> DataFrame:
    """SRC13: one row by key (a pushed-down equality filter)."""
    return dim.where(F.col(key) == F.lit(value))


def point_get_many(dim: DataFrame, key: str, keys: DataFrame, keys_col: str) -> DataFrame:
    """SRC13 for a batch of requests: rows whose key is requested (left-semi join, no duplicates)."""
    return dim.join(keys.select(F.col(keys_col).alias(key)), key, "left_semi")


def merge_cells(changes: DataFrame, key: str, order: Sequence[str], cells: Sequence[str],
                op_col: str = "op", base: DataFrame | None = None) -> DataFrame:
    """SNK5: cell-wise upsert/delete of a dimension.

    Per key, only changes after its last delete count; per cell, the last
    non-empty value wins (empty or null cells do not overwrite). A key whose
    last change is a delete disappears. ``base`` (the current table, same
    columns) is treated as the oldest change. Both steps are aggregates per
    key (map-side combined), so a hot key is not sorted in one task.
    """
    order = list(order)
    arrival = arrival_struct(order)
    if base is not None:
        changes = changes.unionByName(base.select(key, *cells, F.lit("r").alias(op_col),
                                                  *[F.lit(None).cast(changes.schema[o].dataType).alias(o) for o in order]))
    last_delete = changes.groupBy(key).agg(F.max(F.when(F.col(op_col) == "d", arrival)).alias("_last_del"))
    live = (changes.join(last_delete, key, "left")
            .where((F.col(op_col) != "d") & (F.col("_last_del").isNull() | (arrival > F.col("_last_del")))))
    picks = []
    for c in cells:
        nonempty = F.col(c).isNotNull() & (F.col(c).cast("string") != "")
        picks.append(F.max(F.struct(F.when(nonempty, arrival).alias("a"), F.col(c).alias("v"))).alias(f"_m_{c}"))
    merged = live.groupBy(key).agg(*picks)
    return merged.select(key, *[F.when(F.col(f"_m_{c}.a").isNotNull(), F.col(f"_m_{c}.v")).alias(c) for c in cells])


def delete_keys(dim: DataFrame, key: str, deletes: DataFrame, deletes_col: str) -> DataFrame:
    """SNK8: the table without the listed row keys (left-anti join)."""
    return dim.join(deletes.select(F.col(deletes_col).alias(key)), key, "left_anti")


def table_rows(df: DataFrame) -> DataFrame:
    """SNK9: row count as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def create_table_if_absent(spark: SparkSession, name: str, schema_ddl: str, using: str = "parquet") -> None:
    """SNK10: made on first write."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema_ddl}) USING {using}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def list_tables(spark: SparkSession, namespace: str) -> list[str]:
    return [t.name for t in spark.catalog.listTables(namespace)]


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def drop_namespace(spark: SparkSession, namespace: str) -> None:
    """Drop every table in a namespace, then the namespace."""
    spark.sql(f"DROP NAMESPACE IF EXISTS {namespace} CASCADE")
