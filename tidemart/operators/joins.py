"""Joins (JON1-JON13): dimension enrichment, dictionary lookup, interval joins, weight lookup.

Join strategy is left to Catalyst + AQE: no side carries a hint. Spark
broadcasts a side whose size in bytes is below its own threshold, known from
the files or measured at run time from real shuffle sizes; every other join is
a sort-merge join whose skewed partitions AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

__all__ = [
    "EnrichSpec", "enrich", "enrich_chain", "dictionary_lookup", "interval_join",
]

@dataclass
class EnrichSpec:
    """One dimension lookup: ``dim`` joined on ``left_key == dim_key``, adding ``columns``.

    ``columns`` maps a dimension column to its output name.
    """

    dim: DataFrame
    left_key: str
    dim_key: str
    columns: dict[str, str]
    how: str = "inner"


def enrich(df: DataFrame, spec: EnrichSpec) -> DataFrame:
    """JON6: add dimension columns to each row (an equi-join, not a per-row lookup).

    ``how="inner"`` drops rows whose key is missing from the dimension (the
    source system never completes such rows, D8); ``"left"`` keeps them with nulls.
    """
    dim = spec.dim.select(F.col(spec.dim_key).alias("_dk"),
                          *[F.col(src).alias(dst) for src, dst in spec.columns.items()])
    joined = df.join(dim, df[spec.left_key] == dim["_dk"], spec.how)
    return joined.drop("_dk")


def enrich_chain(df: DataFrame, specs: Sequence[EnrichSpec]) -> DataFrame:
    """JON7: fold :func:`enrich` over a list (sku -> spu -> category3 -> 2 -> 1 -> trademark)."""
    for spec in specs:
        df = enrich(df, spec)
    return df


def dictionary_lookup(df: DataFrame, dic: DataFrame, pairs: Sequence[tuple[str, str]],
                      code_col: str = "dic_code", name_path: str = "info.dic_name",
                      how: str = "inner") -> DataFrame:
    """JON4/SRC8: look codes up in one dictionary under several aliases.

    ``pairs`` lists ``(code column, output name column)``. A code that the
    dictionary lacks drops the row (``inner``, D8) or gives a null name (``left``).
    """
    small = dic.select(F.col(code_col).alias("_code"), F.col(name_path).alias("_name"))
    for i, (code, out) in enumerate(pairs):
        alias = small.select(F.col("_code").alias(f"_code{i}"), F.col("_name").alias(out))
        df = df.join(alias, df[code] == alias[f"_code{i}"], how).drop(f"_code{i}")
    return df


def interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  left_time: str, right_time: str, lower_ms: int, upper_ms: int,
                  bucket_ms: int | None = None, cell_rows: int | None = None) -> DataFrame:
    """JON10-JON12: inner join on key with ``left_time + lower <= right_time <= left_time + upper``.

    Times are epoch-ms BIGINT columns; bounds are inclusive milliseconds
    (``lower_ms`` is usually negative). This is the batch form: on streams the
    bound must be on watermarked timestamp columns so that Spark can expire
    join state (see :func:`tidemart.streaming.jobs.age_inference_stream`). With ``bucket_ms`` the
    batch join also matches on a time bucket: the right row's bucket, and each
    bucket the left row's range reaches (a handful of copies when
    ``bucket_ms`` is near the range width).

    A wide range leaves all rows of a heavy key in few buckets. With ``cell_rows`` such a (key, bucket) is cut into a grid:
    its left rows into parts of about ``cell_rows``, its right rows likewise, and each pair of parts meets in a cell of
    its own, so a cell compares at most about ``cell_rows`` squared pairs, a row is copied only as often as its bucket
    has parts on the other side, and each pair still appears once. Buckets below that size are not copied.
    """
    lt, rt = F.col(left_time), F.col(right_time)
    if bucket_ms is None:
        cond = (left[left_key] == right[right_key]) & \
               (right[right_time] >= left[left_time] + lower_ms) & (right[right_time] <= left[left_time] + upper_ms)
        return left.join(right, cond, "inner")
    lb = left.withColumn("_jb", F.explode(F.sequence(F.floor((lt + lower_ms) / bucket_ms).cast("bigint"),
                                                     F.floor((lt + upper_ms) / bucket_ms).cast("bigint"))))
    rb = right.withColumn("_jb", F.floor(rt / bucket_ms).cast("bigint"))
    if cell_rows is not None:
        lb, rb = _grid(lb, rb, left_key, right_key, cell_rows)
        same = F.col("_gl_i").eqNullSafe(F.col("_gr_i")) & F.col("_gl_j").eqNullSafe(F.col("_gr_j"))
    else:
        same = F.lit(True)
    lb, rb = lb.withColumnRenamed("_jb", "_lb"), rb.withColumnRenamed("_jb", "_rb")
    within = (rb[right_time] >= lb[left_time] + lower_ms) & (rb[right_time] <= lb[left_time] + upper_ms)
    out = lb.join(rb, (lb[left_key] == rb[right_key]) & (F.col("_lb") == F.col("_rb")) & same & within, "inner")
    return out.drop("_lb", "_rb", "_gl_i", "_gl_j", "_gr_i", "_gr_j")


def _grid(lb: DataFrame, rb: DataFrame, left_key: str, right_key: str, cell_rows: int) -> tuple[DataFrame, DataFrame]:
    """Cell numbers ``i, j`` for both sides: a left row is in part ``i`` and in every ``j``, a right row the other way.

    Sizes are counted per (key, bucket) with partial aggregates; only buckets that are cut leave a row, and those rows
    are joined back. Parts are dealt by a hash of the row, so a retried task deals alike.
    """
    def parts(df: DataFrame, key: str, name: str) -> DataFrame:
        return df.groupBy(F.col(key).alias("_ck"), F.col("_jb").alias("_cb")).agg(
            F.ceil(F.count(F.lit(1)) / cell_rows).cast("int").alias(name))

    cells = parts(lb, left_key, "_pl").join(parts(rb, right_key, "_pr"), ["_ck", "_cb"]).where("_pl * _pr > 1")

    def dealt(df: DataFrame, key: str, own: str, other: str, i: str, j: str) -> DataFrame:
        plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
        j_all = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1))
        joined = df.join(cells, (F.col(key) == F.col("_ck")) & (F.col("_jb") == F.col("_cb")), "left")
        return joined.select(*df.columns, F.coalesce(F.pmod(F.xxhash64(*plain), F.col(own)), F.lit(0)).cast("int").alias(i),
                             j_all.alias(j))

    return (dealt(lb, left_key, "_pl", "_pr", "_gl_i", "_gl_j"), dealt(rb, right_key, "_pr", "_pl", "_gr_j", "_gr_i"))
