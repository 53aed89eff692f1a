"""Event-time windows and window aggregates (AGG1-AGG10, TIM1-TIM8).

Only tumbling windows exist in the source system (event time, or processing
time for the tag jobs). Aggregates are built-in Spark aggregates, so Spark
does the partial (map-side) and final merge, in batch and in streaming.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.dates import DEFAULT_TZ, EPOCH_NTZ, epoch_ms_of_ntz, is_utc, local_from_epoch_ms
from tidemart.operators.stateful import arrival_struct

__all__ = [
    "with_event_time", "event_time_coalesce", "event_time_seconds", "window_start_of_batch",
    "with_window_cols", "window_aggregate", "last_per_window", "daily_first", "running_profile",
]


def with_event_time(df: DataFrame, ms_col: str, delay: str | None = None, out: str = "et") -> DataFrame:
    """TIM1/TIM2/S8: epoch-ms column -> instant ``et``; bounded out-of-orderness as a watermark."""
    res = df.withColumn(out, F.timestamp_millis(F.col(ms_col).cast("bigint")))
    return res.withWatermark(out, delay) if delay is not None else res


def event_time_coalesce(ts_ms: Column, ts: Column) -> Column:
    """TIM3: time from the record: ``ts_ms``, else ``ts``, else 0 (bad record -> 0)."""
    return F.coalesce(ts_ms.try_cast("bigint"), ts.try_cast("bigint"), F.lit(0).cast("bigint"))


def event_time_seconds(block_ts: Column, ts: Column) -> Column:
    """TIM4: seconds-based time: ``block_timestamp`` if present, else ``timestamp``; -> epoch ms."""
    return (F.coalesce(block_ts.cast("bigint"), ts.cast("bigint")) * 1000).cast("bigint")


def window_start_of_batch(records: Column) -> Column:
    """TIM5: time of a batch-of-records element = ``window_start_time`` of its first record."""
    return F.get(records, 0).getField("window_start_time")


def _ms_of(c: Column, dtype) -> Column:
    if isinstance(dtype, T.TimestampNTZType):
        return epoch_ms_of_ntz(c)
    return F.unix_millis(c)


def _clock_text(ms: Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss' of wall-clock epoch ms by arithmetic and a table of two-digit texts (the formatter outside the
    years 1000 to 9999)."""
    table = F.array(*[F.lit(f"{n:02d}") for n in range(100)])

    def two(n: Column) -> Column:
        return F.get(table, n.cast("int"))

    day = F.date_from_unix_date(F.floor(ms / 86_400_000).cast("int"))
    second = F.floor(F.pmod(ms, F.lit(86_400_000)) / 1000)
    text = F.concat(two(F.floor(F.year(day) / 100)), two(F.year(day) % 100), F.lit("-"), two(F.month(day)), F.lit("-"),
                    two(F.dayofmonth(day)), F.lit(" "), two(F.floor(second / 3600)), F.lit(":"),
                    two(F.floor(second / 60) % 60), F.lit(":"), two(second % 60))
    formatted = F.date_format(local_from_epoch_ms(ms, "UTC"), "yyyy-MM-dd HH:mm:ss")
    return F.when(ms.between(-30_610_224_000_000, 253_402_300_799_999), text).otherwise(formatted)


def _window_texts(df: DataFrame, cols: Sequence[str], start_ms: Column, end_ms: Column, tz: str) -> DataFrame:
    """``cols`` and the window's texts (AGG10) from epoch ms; each step's numbers are made once per row."""
    def wall(ms: Column) -> Column:
        return ms if is_utc(tz) else epoch_ms_of_ntz(local_from_epoch_ms(ms, tz))

    clocks = df.select(*cols, start_ms.alias("_w_start"), end_ms.alias("_w_end"))
    clocks = clocks.select(*cols, wall(F.col("_w_start")).alias("_w_start"), wall(F.col("_w_end")).alias("_w_end"))
    texts = clocks.select(*cols, _clock_text(F.col("_w_start")).alias("stt"), _clock_text(F.col("_w_end")).alias("edt"))
    return texts.withColumn("cur_date", F.substring_index("stt", " ", 1))


def with_window_cols(df: DataFrame, window_col: str = "window", tz: str = DEFAULT_TZ,
                     drop: bool = True) -> DataFrame:
    """AGG10: window start/end as 'yyyy-MM-dd HH:mm:ss' (``stt``, ``edt``) and the start date (``cur_date``)."""
    dtype = df.schema[window_col].dataType["start"].dataType
    cols = [c for c in df.columns if c != window_col] if drop else df.columns
    return _window_texts(df, cols, *[_ms_of(F.col(f"{window_col}.{side}"), dtype) for side in ("start", "end")], tz=tz)


def window_aggregate(df: DataFrame, time_col: str, size: str, keys: Sequence[str], aggs: Sequence[Column],
                     tz: str = DEFAULT_TZ) -> DataFrame:
    """AGG1-AGG5: tumbling window of ``size`` on ``time_col`` grouped by ``keys``; decorated with AGG10."""
    window = F.window(time_col, size)
    if df.isStreaming:  # the watermark closes whole windows
        return with_window_cols(df.groupBy(window.alias("window"), *keys).agg(*aggs), "window", tz)
    # the start tells windows of one size apart: a quarter of the struct's bytes in the aggregate and the shuffle
    grouped = df.groupBy(window.getField("start").alias("window"), *keys).agg(*aggs)
    length = F.timestamp_diff("MILLISECOND", EPOCH_NTZ(), EPOCH_NTZ() + F.expr(f"interval {size.lower().removeprefix('interval ')}"))
    cols = [c for c in grouped.columns if c != "window"]
    start = _ms_of(F.col("window"), grouped.schema["window"].dataType)
    return _window_texts(grouped.withColumn("window", start), cols, F.col("window"), F.col("window") + length, tz)


def last_per_window(df: DataFrame, key, time_col: str, size: str, order, tz: str = DEFAULT_TZ) -> DataFrame:
    """AGG6: per key and tumbling window, the last record by arrival (``max_by``; partial aggregate)."""
    keys = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, str) else list(order)
    others = [c for c in df.columns if c not in keys]
    agg = (df.groupBy(*keys, F.window(time_col, size).alias("window"))
           .agg(F.max_by(F.struct(*others), arrival_struct(order)).alias("_r")))
    flat = agg.select(*keys, "window", *[F.col(f"_r.{c}").alias(c) for c in others])
    return with_window_cols(flat, "window", tz)


def daily_first(df: DataFrame, key: str, day_col: str, order, time_col: str, emit_first: bool = True) -> DataFrame:
    """AGG8: first record per (key, day); emitted only if its time is >= that of the key's previous day.

    ``emit_first=False`` keeps the source system's behaviour of never emitting
    a key's first day (D12). The per-day rows are one per (key, day), so the
    ``lag`` over a key's days works on an aggregated, bounded table.
    """
    order = [order] if isinstance(order, str) else list(order)
    others = [c for c in df.columns if c not in (key, day_col)]
    firsts = (df.groupBy(key, day_col).agg(F.min_by(F.struct(*others), arrival_struct(order)).alias("_r"))
              .select(key, day_col, *[F.col(f"_r.{c}").alias(c) for c in others]))
    w = Window.partitionBy(key).orderBy(day_col)
    prev = F.lag(time_col).over(w)
    keep = F.when(prev.isNull(), F.lit(emit_first)).otherwise(F.col(time_col) >= prev)
    return firsts.withColumn("_keep", keep).where("_keep").select(*df.columns)


def running_profile(df: DataFrame, key: str, time_col: str, size: str, fields: Sequence[str],
                    tz: str = DEFAULT_TZ, sep: str = ",") -> DataFrame:
    """AGG7 fused with AGG6: per key and window, the running record count and the running
    distinct set of each field (sorted, ``sep``-joined) as of the end of that window.

    The sets are kept as (key, field, value, first window) rows, one per distinct value, and joined to the windows
    of their key from the first one on; no frame collects values of all rows. Rows per key after the first aggregate
    are bounded by its windows and distinct values, so a hot key is combined before the shuffle. The running count
    sums per-window counts. Null values are in no set; null keys are one key.
    """
    dfw = df.select(F.col(key).alias("_key"), F.window(time_col, size).alias("window"), *fields)
    # One pass over the input: a count marker plus one (field, value) pair per field, aggregated per
    # (key, window, pair); both branches start from this aggregate, so Spark reuses its exchange.
    marker = F.struct(F.lit("#").alias("f"), F.lit(None).cast("string").alias("v"))
    pairs = dfw.select("_key", "window", F.explode(F.array(marker, *[
        F.struct(F.lit(f).alias("f"), F.col(f).cast("string").alias("v")) for f in fields])).alias("p"))
    step = pairs.groupBy("_key", "window", "p").agg(F.count(F.lit(1)).alias("_c"))
    wk = Window.partitionBy("_key").orderBy("window.start").rowsBetween(Window.unboundedPreceding, 0)
    counts = (step.where(F.col("p.f") == "#")
              .select("_key", "window", F.sum("_c").over(wk).cast("bigint").alias("page_count")))
    firsts = (step.where((F.col("p.f") != "#") & F.col("p.v").isNotNull())
              .groupBy(F.col("_key").alias("_fk"), "p").agg(F.min("window.start").alias("_from")))
    seen = (counts.join(firsts, F.col("_key").eqNullSafe(F.col("_fk")) & (F.col("_from") <= F.col("window.start")), "left")
            .groupBy("_key", "window")
            .agg(F.max("page_count").alias("page_count"),
                 *[F.array_join(F.sort_array(F.collect_set(F.when(F.col("p.f") == f, F.col("p.v")))), sep)
                   .alias(f"{f}_set") for f in fields]))
    return with_window_cols(seen.withColumnRenamed("_key", key), "window", tz)
