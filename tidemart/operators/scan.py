"""Scans in arrival order per key, however many rows a key has.

:func:`ordered_rows` sorts all rows by key and arrival into ranges of about equal size and writes them to the shared
folder; a hot key simply covers many ranges. Whatever a row needs from earlier rows of its key then comes from two
places: a window inside its range, and a carry over ranges. Only the first key of a range can continue an earlier
range, and it is then the last key of the range before, so the carry is a scan over one summary row per range.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.session import checkpoint_dir

__all__ = ["ordered_rows", "previous_row", "running_profile_records"]

_IN_PARTITION = (1 << 33) - 1  # bits of monotonically_increasing_id that count the rows of a partition
_NESTED = (T.MapType, T.ArrayType, T.StructType, T.VariantType)


def _cols(xs) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


def _same(keys: Sequence[str], side: str) -> Column:
    """Null-safe equality of the keys with the fields ``<side>.k0, k1 ...``."""
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"{side}.k{i}"))
    return cond


def _key_struct(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])


def arrival_columns(schema: T.StructType, keys: Sequence[str], order: Sequence[str]) -> list[str]:
    """``order``, then every other plain column: rows of equal arrival are put in order by their content."""
    rest = [f.name for f in schema.fields if f.name not in (*keys, *order) and not isinstance(f.dataType, _NESTED)]
    return [*order, *rest]


def ordered_rows(df: DataFrame, keys, order, ranges: int | None = None, path: str | None = None) -> DataFrame:
    """``df`` with ``_range`` and ``_at``: its place in the order by ``keys`` (null first), then arrival.

    The ranges are cut by sampled quantiles of key and arrival, so they hold about equally many rows whatever the
    keys (``ranges``: their number, else the session's shuffle partitions). Rows of equal arrival follow their other
    plain columns; whole repeats follow their place in the input. The sorted rows are written to ``path``, by default
    a new folder under ``spark.checkpoint.dir``, and reread: places are fixed from then on, also after a lost executor.
    The folder belongs to the caller, who may delete it once results are written.
    """
    keys, order = _cols(keys), _cols(order)
    spark = df.sparkSession
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/scan/{uuid.uuid4().hex}"
    by = [F.col(c).asc_nulls_first() for c in (*keys, *arrival_columns(df.schema, keys, order))]
    tagged = df.withColumn("_tie", F.monotonically_increasing_id())
    dealt = (tagged.repartitionByRange(*by, F.col("_tie")) if ranges is None
             else tagged.repartitionByRange(ranges, *by, F.col("_tie")))
    placed = dealt.sortWithinPartitions(*by, "_tie").select(
        *df.columns, F.spark_partition_id().alias("_range"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION)).alias("_at"))
    placed.write.mode("overwrite").parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def previous_row(ordered: DataFrame, keys, values, prefix: str = "prev_") -> DataFrame:
    """:func:`ordered_rows` without its places, plus ``prev_<v>``: the values of the key's row before (null: none).

    One window per range and one over a summary row per range; a hot key is in no single task.
    """
    keys, values = _cols(keys), _cols(values)
    row = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)])
    ends = ordered.groupBy("_range").agg(F.max_by(row, "_at").alias("_end"))
    carry = ends.select(F.col("_range").alias("_r"), F.lag("_end").over(Window.orderBy("_range")).alias("_carry"))
    inside = ordered.withColumn("_before", F.lag(row).over(Window.partitionBy("_range").orderBy("_at")))
    joined = inside.join(carry, F.col("_range") == F.col("_r"), "left").withColumn("_before", F.coalesce("_before", "_carry"))
    mine = _same(keys, "_before") & F.col("_before").isNotNull()
    return joined.select(*[c for c in ordered.columns if c not in ("_range", "_at")],
                         *[F.when(mine, F.col(f"_before.v{i}")).alias(prefix + v) for i, v in enumerate(values)])


def running_profile_records(df: DataFrame, key, order, fields: Sequence[str], sep: str = ",",
                            ranges: int | None = None, path: str | None = None) -> DataFrame:
    """AGG7 per record: every row with its key's running record count ``page_count`` and, for each field, the distinct
    values up to and including this row (``<field>_set``, sorted, joined by ``sep``; null values are in no set).

    A distributed prefix scan: rows are cut into ranges (:func:`ordered_rows`), counted and collected inside their
    range, and the range's last key hands its count and the values first seen there to the next range. Null keys are
    one key. The sets that travel hold distinct values of edge keys, never rows.
    """
    keys = _cols(key)
    rows = ordered_rows(df, keys, order, ranges, path)
    edge = rows.groupBy("_range").agg(F.max_by(_key_struct(keys), "_at").alias("_last"))
    of_edge = rows.join(edge.withColumnRenamed("_range", "_r"), F.col("_range") == F.col("_r")).where(_same(keys, "_last"))
    # one row per (edge key, field, value) with the range that saw it first, beside one marker per range for the count
    marker = F.struct(F.lit(-1).alias("f"), F.lit(None).cast("string").alias("v"))
    seen = of_edge.select("_last", "_range", F.explode(F.array(marker, *[
        F.struct(F.lit(i).alias("f"), F.col(f).cast("string").alias("v")) for i, f in enumerate(fields)])).alias("p"))
    seen = seen.where("p.f = -1 or p.v is not null").select("_last", "p.f", "p.v", F.when(
        F.col("p.f") == -1, F.col("_range")).alias("_mark"), "_range")
    seen = seen.groupBy("_last", "f", "v", "_mark").agg(F.min("_range").alias("_range"), F.count(F.lit(1)).alias("c"))
    new = seen.groupBy("_last", "_range").agg(
        F.sum(F.when(F.col("f") == -1, F.col("c"))).alias("c"),
        *[F.collect_list(F.when(F.col("f") == i, F.col("v"))).alias(f"s{i}") for i in range(len(fields))])
    upto = Window.partitionBy("_last").orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    totals = new.select("_range", F.struct(
        F.col("_last"), F.sum("c").over(upto).alias("c"),
        *[F.flatten(F.collect_list(f"s{i}").over(upto)).alias(f"s{i}") for i in range(len(fields))]).alias("_total"))
    carry = totals.select(F.col("_range").alias("_r"), F.lag("_total").over(Window.orderBy("_range")).alias("_carry"))
    carry = carry.select("_r", F.col("_carry._last").alias("_from"), "_carry")
    here = Window.partitionBy("_range", *keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.select("*", F.count(F.lit(1)).over(here).alias("_n"), *[
        F.collect_set(F.col(f).cast("string")).over(here).alias(f"_i{i}") for i, f in enumerate(fields)])
    joined = inside.join(carry, F.col("_range") == F.col("_r"), "left")
    goes_on = _same(keys, "_from") & F.col("_carry").isNotNull()
    return joined.select(
        *df.columns, (F.col("_n") + F.when(goes_on, F.col("_carry.c")).otherwise(0)).cast("bigint").alias("page_count"),
        *[F.array_join(F.array_sort(F.when(goes_on, F.array_union(f"_carry.s{i}", f"_i{i}")).otherwise(
            F.col(f"_i{i}"))), sep).alias(f"{f}_set") for i, f in enumerate(fields)])
