"""Order-dependent per-key operators (STA1-STA8) in their batch form.

The streaming system keeps a value per key and updates it record by record.
In batch the same answer is a function of each row and of *one other row of
its key* (the first one, or the previous one in arrival order). Both are
computed without putting a whole key into one task:

* "first row per key" is a ``min_by`` aggregate (partial aggregation on the
  map side, one row per key after the shuffle), joined back on the key; AQE
  splits a hot key on the big side of that join.
* "previous row per key" (:func:`keyed_lag`) is a ``lag`` per key, or per
  ``(key, range of the first arrival column)`` for hot keys; the first row of
  a range takes the last row of the preceding range from a per-range summary.

Arrival order is a list of columns; the rows must be totally ordered by it.
Streaming forms live in :mod:`tidemart.streaming.processors`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

__all__ = [
    "arrival_struct", "first_row_per_key", "keyed_lag", "retract_dedupe", "retract_dedupe_ttl",
    "first_per_key", "last_per_key", "exact_dedupe", "composite_dedupe", "new_visitor_fix", "visit_flags",
]


def _cols(xs) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


def arrival_struct(order: Sequence[str]) -> Column:
    """Lexicographic arrival key (struct comparison follows field order)."""
    return F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])


def first_row_per_key(df: DataFrame, keys, order, values, prefix: str = "first_") -> DataFrame:
    """Per key, the listed values of its first row by arrival (``min_by``; partial aggregate)."""
    keys, values = _cols(keys), _cols(values)
    picked = F.min_by(F.struct(*[F.col(v) for v in values]), arrival_struct(_cols(order)))
    agg = df.groupBy(*keys).agg(picked.alias("_first"))
    return agg.select(*keys, *[F.col(f"_first.{v}").alias(prefix + v) for v in values])


def keyed_lag(df: DataFrame, keys, order, values, range_width: int | None = None, prefix: str = "prev_") -> DataFrame:
    """Add ``prev_<v>``: the value of the previous row of the same key in arrival order (null keys are one key).

    Without ``range_width``: one window per key, for keys of few rows. With it (the first arrival column must be
    numeric), a key is cut into ranges of that width of the first arrival column, so the ranges follow arrival by
    construction; rows are windowed per (key, range), and the first row of a range takes the last row of the range
    before it from one summary row per (key, range). Choose a width that leaves few ranges per key.
    """
    keys, order, values = _cols(keys), _cols(order), _cols(values)
    if range_width is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.select("*", *[F.lag(v).over(w).alias(prefix + v) for v in values])

    base = df.withColumn("_range", F.floor(F.col(order[0]) / range_width))
    w = Window.partitionBy(*keys, "_range").orderBy(*order)
    inner = base.select("*", F.lag(F.lit(1)).over(w).isNull().alias("_first_in_range"),
                        F.lead(F.lit(1)).over(w).isNull().alias("_last_in_range"),
                        *[F.lag(v).over(w).alias("_in_" + v) for v in values])
    wr = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))]).orderBy("_r")
    carry = (inner.where("_last_in_range")
             .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_range").alias("_r"),
                     F.struct(*[F.col(v) for v in values]).alias("_last"))
             .withColumn("_carry", F.lag("_last").over(wr)).drop("_last"))
    same = F.col("_range").eqNullSafe(F.col("_r"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    joined = inner.join(carry, same, "left")
    return joined.select(
        *df.columns,
        *[F.when(F.col("_first_in_range"), F.col(f"_carry.{v}")).otherwise(F.col("_in_" + v)).alias(prefix + v)
          for v in values])


def retract_dedupe(df: DataFrame, key, order, amounts, sign_col: str = "sign", net: bool = False) -> DataFrame:
    """STA4: on a repeated id emit the previous record with its amounts negated, then the new one.

    Batch form. The emitted multiset is: every row with sign +1, and every row that has a successor in its id with
    sign -1 (the record its successor retracts). One window per id (one shuffle, one sort); exact repeats retract
    each other, rows of a null id belong to one id. Amount negation is numeric (null stays null).

    ``net=True`` returns the aggregate-ready form: the retractions of an id telescope, so any sum over the stream
    equals the sum of each id's *last* record: one ``max_by`` aggregate per id, which also takes a hot id.
    """
    keys, order, amounts = _cols(key), _cols(order), _cols(amounts)
    if net:
        return last_per_key(df, keys, order).withColumn(sign_col, F.lit(1))
    w = Window.partitionBy(*keys).orderBy(*order)
    signs = F.when(F.col("_is_last"), F.array(F.lit(1))).otherwise(F.array(F.lit(1), F.lit(-1)))
    tagged = df.withColumn("_is_last", F.lead(F.lit(1)).over(w).isNull())
    exploded = tagged.select(*df.columns, F.explode(signs).alias(sign_col))
    return exploded.select(
        *[(F.col(c) * F.col(sign_col)).cast(df.schema[c].dataType).alias(c) if c in amounts else F.col(c)
          for c in df.columns], sign_col)


def retract_dedupe_ttl(df: DataFrame, key, order, amounts, time_col: str, ttl_ms: int,
                       sign_col: str = "sign") -> DataFrame:
    """STA5: STA4 whose per-id memory expires ``ttl_ms`` after it was last written.

    A repeat retracts the previous record only when that record arrived at
    most ``ttl_ms`` earlier (``time_col`` is an epoch-ms arrival time). Each
    row yields itself and, when the memory is live, the whole previous record
    with its amounts negated, through one ``explode`` (the lag runs once).
    """
    keys, order, amounts = _cols(key), _cols(order), _cols(amounts)
    others = [c for c in df.columns if c not in keys]
    lagged = keyed_lag(df, keys, order, others, prefix="_p_")
    live = F.col(f"_p_{time_col}").isNotNull() & ((F.col(time_col) - F.col(f"_p_{time_col}")) <= ttl_ms)
    cur = F.struct(F.lit(1).alias("_s"), *[F.col(c).alias(c) for c in others])
    prev = F.struct(F.lit(-1).alias("_s"), *[
        ((-F.col(f"_p_{c}")).cast(df.schema[c].dataType) if c in amounts else F.col(f"_p_{c}")).alias(c)
        for c in others])
    rows = F.when(live, F.array(cur, prev)).otherwise(F.array(cur))
    out = lagged.select(*keys, F.explode(rows).alias("_r"))
    return out.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns],
                      F.col("_r._s").alias(sign_col))


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    """STA3/STA6: the first record per key by arrival (one ``min_by`` aggregate, map-side combined)."""
    keys, order = _cols(keys), _cols(order)
    others = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.min_by(F.struct(*others), arrival_struct(order)).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others]).select(*df.columns)


def last_per_key(df: DataFrame, keys, order) -> DataFrame:
    """SNK3 keyed latest: the last record per key by arrival (``max_by``; map-side combined)."""
    keys, order = _cols(keys), _cols(order)
    others = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*others), arrival_struct(order)).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others]).select(*df.columns)


def exact_dedupe(df: DataFrame) -> DataFrame:
    """STA7: drop exact repeats of the whole record (map columns compared through ``to_json``)."""
    maps = [f.name for f in df.schema.fields if f.dataType.typeName() == "map"]
    if not maps:
        return df.dropDuplicates()
    keyed = df.select("*", *[F.to_json(F.col(m)).alias(f"_k_{m}") for m in maps])
    keys = [c for c in df.columns if c not in maps] + [f"_k_{m}" for m in maps]
    return keyed.dropDuplicates(keys).select(*df.columns)


def composite_dedupe(df: DataFrame, a: str, b: str, order) -> DataFrame:
    """STA8 exact form: keep the first record of each ``a + '_' + b`` pair.

    The source system uses a Bloom filter (false positives drop good rows);
    this is the exact answer: pairs are compared as two columns, null being
    a value of its own. See
    :class:`tidemart.streaming.processors.BloomDedupe` for the fixed-memory form.
    """
    return first_per_key(df, [a, b], order)


def new_visitor_fix(df: DataFrame, key: str, order, date_col: str, is_new_col: str = "is_new",
                    out_col: str | None = None) -> DataFrame:
    """STA1: repair ``is_new`` per device.

    The key's memory is set once, by its first record: that record's date if
    it says new, else the day before. A later record that says new on another
    date is corrected to ``'0'``. ``date_col`` is a DATE.
    """
    out_col = out_col or is_new_col
    first = first_row_per_key(df, key, order, [date_col, is_new_col], prefix="_f_")
    state = first.select(key, F.when(F.col(f"_f_{is_new_col}") == "1", F.col(f"_f_{date_col}"))
                         .otherwise(F.date_sub(F.col(f"_f_{date_col}"), 1)).alias("_state_date"))
    joined = df.join(state, on=key, how="left")
    fixed = F.when((F.col(is_new_col) == "1") & (F.col("_state_date") != F.col(date_col)), F.lit("0")) \
        .otherwise(F.col(is_new_col))
    cols = [fixed.alias(out_col) if c == out_col else F.col(c) for c in df.columns]
    if out_col not in df.columns:
        cols.append(fixed.alias(out_col))
    return joined.select(*cols)


def visit_flags(df: DataFrame, key: str, order, date_col: str, last_page_col: str, ranges: int | None = None) -> DataFrame:
    """STA2: ``uv_ct`` = 1 when the date differs from that of the key's previous record (or there is none);
    ``sv_ct`` = 1 when there is no last page; ``pv_ct`` = 1.

    "Previous" is by arrival: ``order`` need not follow time, and a date that comes back counts again. Rows of equal
    arrival follow their other columns, so exactly one of them is the first. A null date is a value of its own.
    Rows are cut into ranges of key and arrival (:mod:`tidemart.operators.scan`), so a hot device is in no single task.
    """
    from tidemart.operators.scan import ordered_rows, previous_row

    last = F.struct(F.col(date_col).alias("d"))  # tells a null date from no record
    rows = ordered_rows(df.withColumn("_day", last), key, order, ranges)
    flagged = previous_row(rows, key, ["_day"])
    lp = F.col(last_page_col)
    return flagged.select(
        *df.columns, (F.col("prev__day").isNull() | ~F.col("prev__day.d").eqNullSafe(F.col(date_col))).cast("bigint").alias("uv_ct"),
        F.when(lp.isNull() | (lp == ""), 1).otherwise(0).cast("bigint").alias("sv_ct"),
        F.lit(1).cast("bigint").alias("pv_ct"))
