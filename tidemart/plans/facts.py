"""Fact queries (DWD layer): change-feed filters, routing, cart adds, order detail, refunds, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.functions.dates import ms_to_date
from tidemart.operators.joins import EnrichSpec, dictionary_lookup, enrich, enrich_chain
from tidemart.operators.routing import (after_fields, apply_sink_columns, build_envelopes, cart_adds, detail_activities,
                                        detail_coupons, filter_cdc, latest_rules, order_details, order_headers,
                                        refund_requests, refunds_moved, route_by_rules, status_transition)
from tidemart.operators.stateful import keyed_lag
from tidemart.plans.registry import query
from tidemart.plans.tables import (CUSTOMER_BIRTHDAY_SQL, LINEITEM_ARRIVAL, LINEITEM_ARRIVAL_SQL, ORDER_DATE_MS_SQL,
                                   TZ, cents, customer_birthday_day, customer_envelopes, detail_id, epoch_ms, from_cents,
                                   money, order_envelopes, order_feed, refund_envelopes, table)


@query("cdc_filter", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
       CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR) AS total_amount, o_orderstatus AS order_status,
       CASE o_orderstatus WHEN 'O' THEN 'c' ELSE 'r' END AS op, {ORDER_DATE_MS_SQL} AS ts_ms,
       strftime(o_orderdate, '%Y-%m-%d') AS cur_date
FROM orders WHERE o_orderstatus IN ('O', 'P')
""")
def cdc_filter(spark, sf_dir):
    """SRC1/SRC6: a two-table feed filtered to one table and to insert/snapshot ops; fields from ``after``."""
    feed = order_envelopes(spark, sf_dir).unionByName(customer_envelopes(spark, sf_dir))
    rows = filter_cdc(feed, db="shop", table="order_info", ops=("c", "r"))
    out = after_fields(rows, ["id", "user_id", "total_amount", "order_status"], keep=["op", "ts_ms"])
    return out.withColumn("cur_date", ms_to_date("ts_ms", TZ))


# Rule changes for the router (config rows; the later delete removes the order_info rule).
RULE_CHANGES = [
    ("user_info", "dim_user_info", "info", "id,name,nation_id", "id", "c", 1),
    ("base_province", "dim_base_province", "info", "id,name", "id", "c", 1),
    ("sku_info", "dim_sku_info", "info", "id,name,brand", "id", "c", 1),
    ("order_info", "dim_order", "info", "id", "id", "c", 1),
    ("order_info", "dim_order", "info", "id", "id", "d", 2),
]


@query("cdc_route", """
WITH facts AS (
  SELECT 'fact' AS route, '' AS sink_table, CASE o_orderstatus WHEN 'O' THEN 'c' WHEN 'F' THEN 'u' ELSE 'r' END AS op,
         5 AS cells FROM orders),
dims AS (
  SELECT 'dim' AS route, 'dim_user_info' AS sink_table, 'r' AS op, 3 AS cells FROM customer
  UNION ALL SELECT 'dim', 'dim_base_province', 'r', 2 FROM nation
  UNION ALL SELECT 'dim', 'dim_sku_info', CASE WHEN p_partkey % 10 = 0 THEN 'd' ELSE 'u' END,
                   CASE WHEN p_partkey % 10 = 0 THEN 0 ELSE 3 END FROM part)
SELECT route, sink_table, op, count(*) AS n_rows, CAST(sum(cells) AS BIGINT) AS n_cells
FROM (SELECT * FROM facts UNION ALL SELECT * FROM dims) GROUP BY ALL
""")
def cdc_route(spark, sf_dir):
    """PRJ6/PRJ7/STA9/D15: route a mixed feed by the latest rules; dims keep only their sink columns."""
    nat = table(spark, sf_dir, "nation")
    nat_env = build_envelopes(nat, "shop", "base_province", F.lit("r"), F.lit(0), {
        "id": F.col("n_nationkey"), "name": F.col("n_name"), "region_id": F.col("n_regionkey")})
    part = table(spark, sf_dir, "part")
    deleted = F.col("p_partkey") % 10 == 0
    part_env = build_envelopes(part, "shop", "sku_info", F.when(deleted, "d").otherwise("u"), F.lit(0),
                               F.when(~deleted, F.create_map(
                                   F.lit("id"), F.col("p_partkey").cast("string"), F.lit("name"), F.col("p_name"),
                                   F.lit("brand"), F.col("p_brand"), F.lit("size"), F.col("p_size").cast("string"))),
                               F.create_map(F.lit("id"), F.col("p_partkey").cast("string")))
    feed = (order_envelopes(spark, sf_dir).unionByName(customer_envelopes(spark, sf_dir))
            .unionByName(nat_env).unionByName(part_env))
    changes = spark.createDataFrame(RULE_CHANGES, "source_table string, sink_table string, sink_family string, "
                                                   "sink_columns string, sink_row_key string, op string, ts_ms int")
    rules = latest_rules(changes, order=["ts_ms"])
    dims, facts = route_by_rules(feed, rules)
    dims = apply_sink_columns(dims)
    d = dims.select(F.lit("dim").alias("route"), "sink_table", "op",
                    F.coalesce(F.size("after"), F.lit(0)).alias("cells"))
    f = facts.select(F.lit("fact").alias("route"), F.lit("").alias("sink_table"), "op",
                     F.coalesce(F.size("after"), F.lit(0)).alias("cells"))
    return (d.unionByName(f).groupBy("route", "sink_table", "op")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("cells").cast("bigint").alias("n_cells")))


@query("status_transition", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id, o_orderstatus AS order_status,
       {ORDER_DATE_MS_SQL} AS ts_ms
FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority NOT LIKE '1-%'
""")
def status_transition_q(spark, sf_dir):
    """PRJ11: orders whose status moved to F from a known old status."""
    moved = status_transition(order_envelopes(spark, sf_dir), "order_info", "order_status", "F")
    return after_fields(moved, ["id", "user_id", "order_status"], keep=["ts_ms"])


def _cart_envelopes(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", F.col("l_quantity").cast("int").alias("qty"),
        *[c for c in LINEITEM_ARRIVAL if c not in ("l_partkey", "l_suppkey")])
    lagged = keyed_lag(li, ["l_orderkey", "l_linenumber"], LINEITEM_ARRIVAL, ["qty"])
    op = F.when(F.col("prev_qty").isNull(), "c").otherwise("u")
    after = {"id": detail_id("l_orderkey", "l_linenumber"), "user_id": F.col("l_suppkey"),
             "sku_id": F.col("l_partkey"), "sku_num": F.col("qty")}
    before = F.when(F.col("prev_qty").isNotNull(), F.create_map(F.lit("sku_num"), F.col("prev_qty").cast("string")))
    return build_envelopes(lagged, "shop", "cart_info", op, epoch_ms("l_shipdate"), after, before)


@query("cart_add", f"""
WITH l AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS id, l_suppkey, l_partkey,
         CAST(l_quantity AS INTEGER) AS qty, epoch_us(l_shipdate) // 1000 AS ts_ms,
         lag(CAST(l_quantity AS INTEGER)) OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINEITEM_ARRIVAL_SQL}) AS prev
  FROM lineitem)
SELECT id, CAST(l_suppkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS sku_id,
       CASE WHEN prev IS NULL THEN qty ELSE qty - prev END AS sku_num, ts_ms
FROM l WHERE prev IS NULL OR qty > prev
""")
def cart_add(spark, sf_dir):
    """PRJ8/S18/S20: first sight of an id is an insert, later ones updates from the previous quantity;
    keep inserts and rises, quantity = new value or the rise."""
    return cart_adds(_cart_envelopes(spark, sf_dir))


def _with_activity(spark, sf_dir, details):
    """``details`` (order_id, line_no) plus activity and coupon columns, both derived from one aggregate of the line
    items per detail key, joined once (a detail without activity or coupon keeps nulls)."""
    li = table(spark, sf_dir, "lineitem")
    g = li.groupBy(F.col("l_orderkey").alias("g_order"), F.col("l_linenumber").alias("g_line")).agg(
        F.max("l_discount").alias("d"), F.min("l_tax").alias("t"))
    pct = lambda c: (F.col(c).cast("decimal(4,2)") * 100).cast("int")
    active, coupon = F.col("d") >= 0.08, F.col("t") <= 0.01
    cols = g.select("g_order", "g_line",
                    F.when(active, F.concat(F.lit("act_"), pct("d").cast("string"))).alias("activity_id"),
                    F.when(active, F.concat(F.lit("rule_"), (pct("d") % 3).cast("string"))).alias("activity_rule_id"),
                    F.when(coupon, F.concat(F.lit("cpn_"), pct("t").cast("string"))).alias("coupon_id"))
    return details.join(cols, (F.col("order_id") == cols.g_order) & (F.col("line_no") == cols.g_line), "left")


ORDER_DETAIL_WIDE_SQL = f"""
WITH g AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS id, max(l_discount) AS d, min(l_tax) AS t
  FROM lineitem GROUP BY ALL),
act AS (SELECT id, 'act_' || CAST(CAST(CAST(d AS DECIMAL(4,2)) * 100 AS INTEGER) AS VARCHAR) AS activity_id,
               'rule_' || CAST(CAST(CAST(d AS DECIMAL(4,2)) * 100 AS INTEGER) % 3 AS VARCHAR) AS activity_rule_id
        FROM g WHERE d >= 0.08),
cpn AS (SELECT id, 'cpn_' || CAST(CAST(CAST(t AS DECIMAL(4,2)) * 100 AS INTEGER) AS VARCHAR) AS coupon_id
        FROM g WHERE t <= 0.01)
SELECT CAST(l.l_orderkey AS VARCHAR) || '_' || CAST(l.l_linenumber AS VARCHAR) AS id, l.l_orderkey AS order_id,
       o.o_custkey AS user_id, l.l_partkey AS sku_id, p.p_name AS sku_name,
       act.activity_id, act.activity_rule_id, cpn.coupon_id,
       strftime(o.o_orderdate, '%Y-%m-%d') AS date_id, epoch_us(o.o_orderdate) // 1000 AS create_time,
       CAST(l.l_quantity AS BIGINT) AS sku_num,
       CAST(CAST(p.p_retailprice AS DECIMAL(16,2)) * CAST(l.l_quantity AS DECIMAL(16,2)) AS VARCHAR) AS split_original_amount,
       CAST(CAST(l.l_extendedprice AS DECIMAL(16,2)) AS DOUBLE) AS split_total_amount
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
LEFT JOIN act ON act.id = CAST(l.l_orderkey AS VARCHAR) || '_' || CAST(l.l_linenumber AS VARCHAR)
LEFT JOIN cpn ON cpn.id = CAST(l.l_orderkey AS VARCHAR) || '_' || CAST(l.l_linenumber AS VARCHAR)
"""


@query("order_detail_wide", ORDER_DETAIL_WIDE_SQL)
def order_detail_wide(spark, sf_dir):
    """PRJ9/PRJ10/JON1/JON2/S21: detail ⋈ header, ⟕ activity, ⟕ coupon (+ sku name); the
    original amount is a DECIMAL(16,2) x DECIMAL(16,2) product rendered as text."""
    li = table(spark, sf_dir, "lineitem")
    det = li.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
                    F.col("l_partkey").alias("sku_id"), F.col("l_quantity").alias("qty"), "l_extendedprice")
    head = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = table(spark, sf_dir, "part")
    j = _with_activity(spark, sf_dir, det.join(head, det.order_id == head.o_orderkey, "inner"))
    j = enrich(j, EnrichSpec(part, "sku_id", "p_partkey", {"p_name": "sku_name", "p_retailprice": "_price"}))
    return j.select(detail_id().alias("id"), "order_id", F.col("o_custkey").alias("user_id"), "sku_id", "sku_name",
                    "activity_id", "activity_rule_id", "coupon_id",
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_id"),
                    epoch_ms("o_orderdate").alias("create_time"), F.col("qty").cast("bigint").alias("sku_num"),
                    (money("_price") * money("qty")).cast("string").alias("split_original_amount"),
                    from_cents(cents("l_extendedprice")).alias("split_total_amount"))


@query("order_detail_feed", ORDER_DETAIL_WIDE_SQL)
def order_detail_feed(spark, sf_dir):
    """PRJ9/PRJ10/JON1/JON2 end to end from the change feed: details, headers, activities and coupons are taken from one
    feed of inserts by the source's projections and joined. (Each projection prunes the feed to its own table.)"""
    env = order_feed(spark, sf_dir)
    head = order_headers(env).select(F.col("id").alias("h_id"), F.col("user_id").cast("bigint").alias("user_id"))
    # typed before the joins: numbers are narrower than their text in the shuffles
    det = order_details(env).select(
        "id", "order_id", F.col("sku_id").cast("bigint").alias("sku_id"), "sku_name",
        F.col("create_time").cast("bigint").alias("create_time"), F.col("sku_num").cast("bigint").alias("sku_num"),
        "split_original_amount", F.col("split_total_amount").cast("double").alias("split_total_amount"))
    act = detail_activities(env).select(F.col("order_detail_id").alias("a_id"), "activity_id", "activity_rule_id")
    cpn = detail_coupons(env).select(F.col("order_detail_id").alias("c_id"), "coupon_id")
    j = det.join(head, det.order_id == head.h_id, "inner").drop("h_id")
    j = j.withColumn("order_id", F.col("order_id").cast("bigint"))
    j = j.join(act, F.col("id") == act.a_id, "left").join(cpn, F.col("id") == cpn.c_id, "left")
    return j.select("id", "order_id", "user_id", "sku_id", "sku_name",
                    "activity_id", "activity_rule_id", "coupon_id", ms_to_date(F.col("create_time"), TZ).alias("date_id"),
                    "create_time", "sku_num", "split_original_amount", "split_total_amount")


@query("refund_moved", """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku_id,
       CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS refund_num
FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'
""")
def refund_moved(spark, sf_dir):
    """PRJ12, update form: order, SKU and quantity of refunds whose status moved to the paid one."""
    return refunds_moved(refund_envelopes(spark, sf_dir), "1602")


def _refund_requests(spark, sf_dir):
    """Refund requests by the source's projection of the feed's inserts, typed."""
    req = refund_requests(refund_envelopes(spark, sf_dir))
    return req.select("id", *[F.col(c).cast("bigint").alias(c) for c in ("order_id", "sku_id")], "refund_type",
                      F.col("refund_num").cast("int").alias("refund_num"), "refund_amount", "refund_reason_type")


def _moved_orders(spark, sf_dir):
    moved = status_transition(order_envelopes(spark, sf_dir), "order_info", "order_status", "F")
    return moved.select(F.col("after")["id"].cast("bigint").alias("o_id"), F.col("after")["user_id"].alias("user_id"),
                        F.col("after")["order_status"].alias("order_status"),
                        F.col("ts_ms").alias("order_ts_ms"))


@query("refund_order", f"""
SELECT CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS id, l_orderkey AS order_id,
       l_partkey AS sku_id, CAST(o_custkey AS VARCHAR) AS user_id, strftime(o_orderdate, '%Y-%m-%d') AS date_id,
       'type_' || CAST(l_linenumber % 3 AS VARCHAR) AS refund_type, CAST(l_quantity AS INTEGER) AS refund_num,
       CAST(CAST(l_extendedprice AS DECIMAL(16,2)) AS VARCHAR) AS refund_amount, o_orderstatus AS order_status
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_returnflag = 'R' AND o_orderstatus = 'F' AND o_orderpriority NOT LIKE '1-%'
""")
def refund_order(spark, sf_dir):
    """PRJ12/JON3: refund requests joined with the orders that moved to the refund status."""
    req = _refund_requests(spark, sf_dir)
    moved = _moved_orders(spark, sf_dir)
    j = req.join(moved, req.order_id == moved.o_id, "inner")
    return j.select("id", "order_id", "sku_id", "user_id", ms_to_date("order_ts_ms", TZ).alias("date_id"),
                    "refund_type", "refund_num", "refund_amount", "order_status")


def _code_dictionary(df, *code_cols):
    """A ``base_dic``-shaped dictionary (dic_code, info.dic_name) of the codes seen in the data."""
    codes = None
    for c in code_cols:
        part = df.select(F.col(c).cast("string").alias("dic_code"))
        codes = part if codes is None else codes.unionByName(part)
    codes = codes.distinct()
    return codes.select("dic_code", F.struct(F.concat(F.lit("name:"), F.col("dic_code")).alias("dic_name")).alias("info"))


@query("lookup_dict", """
SELECT o_orderkey, 'name:' || o_orderpriority AS priority_name, 'name:' || o_orderstatus AS status_name FROM orders
""")
def lookup_dict(spark, sf_dir):
    """JON4/SRC8: one dictionary looked up under two aliases (priority and status names)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    dic = _code_dictionary(o, "o_orderpriority", "o_orderstatus")
    out = dictionary_lookup(o, dic, [("o_orderpriority", "priority_name"), ("o_orderstatus", "status_name")])
    return out.select("o_orderkey", "priority_name", "status_name")


@query("refund_paid", """
WITH r AS (SELECT * FROM lineitem WHERE l_returnflag = 'R'),
pay AS (SELECT * FROM r WHERE l_linestatus = 'F')
SELECT CAST(p.l_orderkey AS VARCHAR) || '_' || CAST(p.l_linenumber AS VARCHAR) AS id, p.l_orderkey AS order_id,
       p.l_partkey AS sku_id, CAST(o.o_custkey AS VARCHAR) AS user_id,
       'name:pay_' || CAST(p.l_suppkey % 3 AS VARCHAR) AS payment_type_name,
       CAST(q.l_quantity AS INTEGER) AS refund_num, CAST(CAST(q.l_extendedprice AS DECIMAL(16,2)) AS VARCHAR) AS refund_amount,
       epoch_us(p.l_shipdate) // 1000 AS callback_time
FROM pay p JOIN r q ON p.l_orderkey = q.l_orderkey AND p.l_partkey = q.l_partkey
JOIN orders o ON p.l_orderkey = o.o_orderkey
WHERE o.o_orderstatus = 'F' AND o.o_orderpriority NOT LIKE '1-%'
""")
def refund_paid(spark, sf_dir):
    """PRJ13/JON5/S19: refund payments that reached the paid status ⋈ requests on (order, sku)
    ⋈ moved orders ⋈ payment-type dictionary (struct path ``info.dic_name``)."""
    li = table(spark, sf_dir, "lineitem").where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"))
    pay_env = build_envelopes(li, "shop", "refund_payment", F.lit("u"), epoch_ms("l_shipdate"), {
        "id": F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")),
        "order_id": F.col("l_orderkey"), "sku_id": F.col("l_partkey"),
        "payment_type": F.concat(F.lit("pay_"), (F.col("l_suppkey") % 3).cast("string")),
        "refund_status": F.lit("1602")}, {"refund_status": F.lit("0701")})
    paid = status_transition(pay_env, "refund_payment", "refund_status", "1602")
    pay = after_fields(paid, ["id", "order_id", "sku_id", "payment_type"], keep=[F.col("ts_ms").alias("callback_time")])
    req = _refund_requests(spark, sf_dir).select(F.col("order_id").alias("r_order"), F.col("sku_id").alias("r_sku"),
                                                 "refund_num", "refund_amount")
    moved = _moved_orders(spark, sf_dir)
    j = (pay.join(req, (pay.order_id.cast("bigint") == req.r_order) & (pay.sku_id.cast("bigint") == req.r_sku))
         .join(moved, F.col("order_id").cast("bigint") == moved.o_id))
    dic = _code_dictionary(pay, "payment_type")
    j = dictionary_lookup(j, dic, [("payment_type", "payment_type_name")])
    return j.select("id", F.col("order_id").cast("bigint").alias("order_id"), F.col("sku_id").cast("bigint").alias("sku_id"),
                    "user_id", "payment_type_name", "refund_num", "refund_amount", "callback_time")


@query("dim_chain", """
SELECT CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS id, l_partkey AS sku_id,
       p_name AS sku_name, p_brand AS tm_name, p_type AS category3_name, s_name AS supp_name,
       n_name AS nation_name, r_name AS region_name
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def dim_chain(spark, sf_dir):
    """JON6/JON7: a fold of dimension enrichments (sku -> supplier -> nation -> region)."""
    li = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"),
        F.col("l_partkey").alias("sku_id"), "l_suppkey")
    specs = [
        EnrichSpec(table(spark, sf_dir, "part"), "sku_id", "p_partkey",
                   {"p_name": "sku_name", "p_brand": "tm_name", "p_type": "category3_name"}),
        EnrichSpec(table(spark, sf_dir, "supplier"), "l_suppkey", "s_suppkey",
                   {"s_name": "supp_name", "s_nationkey": "_nation"}),
        EnrichSpec(table(spark, sf_dir, "nation"), "_nation", "n_nationkey",
                   {"n_name": "nation_name", "n_regionkey": "_region"}),
        EnrichSpec(table(spark, sf_dir, "region"), "_region", "r_regionkey", {"r_name": "region_name"}),
    ]
    out = enrich_chain(li, specs)
    return out.select("id", "sku_id", "sku_name", "tm_name", "category3_name", "supp_name", "nation_name",
                      "region_name")


@query("order_user", f"""
SELECT o_orderkey AS order_id, o_custkey AS user_id, c_name AS user_login_name, c_mktsegment AS user_level,
       {CUSTOMER_BIRTHDAY_SQL} AS user_birthday, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS user_gender
FROM orders JOIN customer ON o_custkey = c_custkey
""")
def order_user(spark, sf_dir):
    """JON9: orders enriched with user attributes."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"))
    cust = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", customer_birthday_day().alias("birthday"),
        F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"))
    out = enrich(o, EnrichSpec(cust, "user_id", "c_custkey", {
        "c_name": "user_login_name", "c_mktsegment": "user_level", "birthday": "user_birthday",
        "gender": "user_gender"}))
    return out
