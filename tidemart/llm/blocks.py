"""Comparing all rows of a bucket with each other, however large the bucket is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = ["block_pairs"]


def block_pairs(members: DataFrame, keys: list[str], spread: Column, block_rows: int) -> DataFrame:
    """Deal bucket members over pairs of blocks so that any two members of a bucket meet in exactly one group.

    A bucket of n rows is cut into ``g = ceil(n / block_rows)`` blocks by ``spread`` (a BIGINT hash). The group of
    blocks (i, j), i <= j, holds both blocks; a row goes to g groups. Adds ``blk`` (the row's block), ``blocks`` (g) and
    the group's ``bi, bj``; group by ``keys + [bi, bj]``. In the group (i, i) every pair is compared, in (i, j) only pairs of
    different blocks. No group holds much more than 2 * ``block_rows`` rows; buckets of one row are left out, as
    they have no pair.
    """
    sizes = members.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(
        *keys, F.ceil(F.col("_n") / F.lit(block_rows)).cast("int").alias("_g"))
    m = members.join(sizes, keys).withColumn("blk", F.pmod(spread, F.col("_g")).cast("int"))
    m = m.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_g") - 1)))
    return m.select(*members.columns, "blk", F.col("_g").alias("blocks"), F.least("blk", "_o").alias("bi"), F.greatest("blk", "_o").alias("bj"))
