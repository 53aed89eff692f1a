"""Change-feed filtering, routing and fact projections (SRC1, SRC6, PRJ6-PRJ13).

A change envelope carries ``before``/``after`` as string maps and the source
table in ``source['table']``. Facts are projections of one table's envelopes;
dimension routing is a join with the latest rule per source table.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.operators.stateful import arrival_struct

__all__ = [
    "build_envelopes", "filter_cdc", "after_fields", "status_transition", "cart_adds",
    "order_details", "order_headers", "detail_activities", "detail_coupons", "refund_requests", "refunds_moved",
    "latest_rules", "route_by_rules", "apply_sink_columns",
]


def build_envelopes(df: DataFrame, db: str, table: str, op: Column, ts_ms: Column,
                    after: dict[str, Column] | Column | None,
                    before: dict[str, Column] | Column | None = None) -> DataFrame:
    """Make change envelopes from rows (used to replay tables as a change feed).

    ``after``/``before`` are ``{field: column}`` dicts or ready map columns.
    """

    def as_map(cols):
        if cols is None:
            return F.lit(None).cast("map<string,string>")
        if isinstance(cols, Column):
            return cols.cast("map<string,string>")
        # create_map: the optimizer takes a field read from it for the field's column, so projections make no map
        return F.create_map(*[x for k, c in cols.items() for x in (F.lit(k), c.cast("string"))])

    source = F.create_map(F.lit("db"), F.lit(db), F.lit("table"), F.lit(table), F.lit("ts_ms"), ts_ms.cast("string"))
    return df.select(as_map(before).alias("before"), as_map(after).alias("after"), source.alias("source"),
                     op.alias("op"), ts_ms.cast("bigint").alias("ts_ms"))


def filter_cdc(env: DataFrame, db: str | None = None, table: str | None = None,
               ops: Iterable[str] | None = None) -> DataFrame:
    """SRC1/SRC6: keep envelopes of one database/table (``'*'`` or None = all) and ops."""
    cond = F.lit(True)
    if db not in (None, "*"):
        cond = cond & (F.col("source")["db"] == db)
    if table not in (None, "*"):
        cond = cond & (F.col("source")["table"] == table)
    if ops is not None:
        cond = cond & F.col("op").isin(list(ops))
    return env.where(cond)


def after_fields(env: DataFrame, fields: Sequence[str], side: str = "after", keep: Sequence[str] = ()) -> DataFrame:
    """Project map fields to columns (S18: a missing key is NULL)."""
    return env.select(*[F.col(side)[f].alias(f) for f in fields], *keep)


def status_transition(env: DataFrame, table: str, column: str, to_status: str, ops=("u",)) -> DataFrame:
    """PRJ11/PRJ13: updates of ``table`` whose ``column`` moved to ``to_status`` (old value present)."""
    return filter_cdc(env, table=table, ops=ops).where(
        F.col("before")[column].isNotNull() & (F.col("after")[column] == to_status))


def cart_adds(env: DataFrame, table: str = "cart_info") -> DataFrame:
    """PRJ8: inserts, or updates that raise ``sku_num``; quantity = new value or the rise."""
    new = (F.col("after")["sku_num"]).try_cast("int")
    old = (F.col("before")["sku_num"]).try_cast("int")
    rows = filter_cdc(env, table=table).where(
        (F.col("op") == "c") | ((F.col("op") == "u") & old.isNotNull() & (new > old)))
    qty = F.when(F.col("op") == "c", new).otherwise(new - old)
    return rows.select(F.col("after")["id"].alias("id"), F.col("after")["user_id"].alias("user_id"),
                       F.col("after")["sku_id"].alias("sku_id"), qty.alias("sku_num"), F.col("ts_ms"))


# Fields of the facts (fixed values: column names of the source's tables).
DETAIL_FIELDS = ("id", "order_id", "sku_id", "sku_name", "create_time", "source_id", "source_type", "sku_num")
DETAIL_AMOUNT_FIELDS = ("split_total_amount", "split_activity_amount", "split_coupon_amount")
REFUND_FIELDS = ("id", "user_id", "order_id", "sku_id", "refund_type", "refund_num", "refund_amount",
                 "refund_reason_type", "refund_reason_txt", "create_time")


def order_details(env: DataFrame, insert_ops: Sequence[str] = ("c",), table: str = "order_detail") -> DataFrame:
    """PRJ9: order-detail facts of inserted rows. The original amount is quantity x price, a product of two
    DECIMAL(16,2) as text (null when either is no number). ``insert_ops=("c", "r")`` also takes snapshot rows (D16)."""
    after = F.col("after")
    num, price = after["sku_num"].try_cast("decimal(16,2)"), after["order_price"].try_cast("decimal(16,2)")
    return filter_cdc(env, table=table, ops=insert_ops).select(
        *[after[f].alias(f) for f in DETAIL_FIELDS], (num * price).cast("string").alias("split_original_amount"),
        *[after[f].alias(f) for f in DETAIL_AMOUNT_FIELDS], F.col("source")["ts_ms"].alias("ts_ms"))


def order_headers(env: DataFrame, insert_ops: Sequence[str] = ("c",), table: str = "order_info") -> DataFrame:
    """PRJ10: headers of inserted orders."""
    return after_fields(filter_cdc(env, table=table, ops=insert_ops), ["id", "user_id", "province_id"])


def detail_activities(env: DataFrame, insert_ops: Sequence[str] = ("c",),
                      table: str = "order_detail_activity") -> DataFrame:
    """PRJ10: activities of order details."""
    return after_fields(filter_cdc(env, table=table, ops=insert_ops),
                        ["id", "order_detail_id", "activity_id", "activity_rule_id"])


def detail_coupons(env: DataFrame, insert_ops: Sequence[str] = ("c",), table: str = "order_detail_coupon") -> DataFrame:
    """PRJ10: coupons of order details."""
    return after_fields(filter_cdc(env, table=table, ops=insert_ops), ["id", "order_detail_id", "coupon_id"])


def refund_requests(env: DataFrame, insert_ops: Sequence[str] = ("c",), table: str = "order_refund_info") -> DataFrame:
    """PRJ12, insert form: refund requests with the change's time."""
    return after_fields(filter_cdc(env, table=table, ops=insert_ops), REFUND_FIELDS,
                        keep=[F.col("source")["ts_ms"].alias("ts_ms")])


def refunds_moved(env: DataFrame, to_status: str, table: str = "order_refund_info") -> DataFrame:
    """PRJ12, update form: order, SKU and quantity of refunds whose status moved to ``to_status``."""
    return after_fields(status_transition(env, table, "refund_status", to_status), ["order_id", "sku_id", "refund_num"])


def latest_rules(rule_changes: DataFrame, order: Sequence[str] = ("ts_ms",)) -> DataFrame:
    """PRJ6 config state: the latest change per ``source_table``; deleted rules removed."""
    cols = [c for c in rule_changes.columns if c not in ("source_table",)]
    latest = (rule_changes.groupBy("source_table")
              .agg(F.max_by(F.struct(*cols), arrival_struct(list(order))).alias("_r"))
              .select("source_table", *[F.col(f"_r.{c}").alias(c) for c in cols]))
    return latest.where(F.col("op") != "d").drop("op", *[o for o in order if o != "op"])


def route_by_rules(env: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """PRJ6/PRJ7: (dimension rows with their rule, fact rows).

    One left join on ``source['table']`` splits the feed. Deletes keep their ``before`` image
    (the key of the deleted row, D7), and the record's own op is kept.
    """
    joined = env.join(rules, env["source"]["table"] == rules["source_table"], "left")
    dims = joined.where(F.col("source_table").isNotNull())
    facts = joined.where(F.col("source_table").isNull() & F.col("after").isNotNull()).select(*env.columns)
    return dims, facts


def apply_sink_columns(dims: DataFrame, image: str = "after") -> DataFrame:
    """Keep only the rule's ``sink_columns`` of the row image (comma list)."""
    wanted = F.split(F.col("sink_columns"), ",")
    return dims.withColumn(image, F.map_filter(F.col(image), lambda k, v: F.array_contains(wanted, k)))
