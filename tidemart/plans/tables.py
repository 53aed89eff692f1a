"""The given tables and the feeds derived from them.

The source system reads change envelopes, page logs and order-detail facts.
The driver tables are mapped onto them (user = customer, order = orders,
detail = lineitem, sku = part, province = nation, page log = events,
words = documents). Every derivation is a projection of whole tables, so the
work grows with the data; the matching DuckDB text is kept next to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.dates import epoch_ms_of_ntz

TZ = "UTC"  # driver queries render times in UTC so that DuckDB agrees


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table."""
    from tidemart.sources.files import read_parquet
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def money(c) -> Column:
    """A double money column as DECIMAL(16,2) (exact sums in both engines)."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(16,2)")


# Arrival order of line items that share an id (no two rows are equal on all of these).
LINEITEM_ARRIVAL = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
                    "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
LINEITEM_ARRIVAL_SQL = ", ".join(LINEITEM_ARRIVAL)
DETAIL_AMOUNTS = ["split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount"]


def cents(c) -> Column:
    """A double money column with at most 2 decimals as exact integer cents (BIGINT).

    ``rint`` is exact here because ``x * 100`` is within 1e-6 of an integer.
    Integer cents keep sums and products in primitive, codegen'd arithmetic;
    DECIMAL(16,2) x DECIMAL(16,2) widens to DECIMAL(33,4), which Spark computes
    with ``BigDecimal`` per row (measured 4x slower at sf0.1).
    """
    return F.rint((F.col(c) if isinstance(c, str) else c) * 100).cast("bigint")


def cents_product(a_cents: Column, b_cents: Column) -> Column:
    """``round(a * b, 2)`` HALF_UP for non-negative cents values, as cents."""
    return F.floor((a_cents * b_cents + 50) / 100).cast("bigint")


def from_cents(c) -> Column:
    """Cents -> DOUBLE (the nearest double to the exact decimal, as DuckDB's decimal cast gives)."""
    return ((F.col(c) if isinstance(c, str) else c) / 100.0).cast("double")


def detail_id(order_col: str = "order_id", line_col: str = "line_no") -> Column:
    return F.concat_ws("_", F.col(order_col).cast("string"), F.col(line_col).cast("string"))


DETAIL_KEY = ["order_id", "line_no"]


def order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-detail facts from ``lineitem``: key (order_id, line_no), four amounts in integer cents.

    The source system's text id is ``order_id‖'_'‖line_no`` (:func:`detail_id`),
    built only where it is output.
    """
    li = table(spark, sf_dir, "lineitem")
    orig = cents("l_extendedprice")
    act = cents_product(orig, cents("l_discount"))
    cpn = cents_product(orig, cents("l_tax"))
    return li.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("sku_id"), F.col("l_suppkey").alias("supp_id"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        orig.alias("split_original_amount"), act.alias("split_activity_amount"),
        cpn.alias("split_coupon_amount"), (orig - act - cpn).alias("split_total_amount"),
        *LINEITEM_ARRIVAL)


ORDER_DETAILS_SQL = f"""
SELECT CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS id,
       l_orderkey AS order_id, l_partkey AS sku_id, l_suppkey AS supp_id,
       CAST(l_quantity AS BIGINT) AS sku_num,
       CAST(l_extendedprice AS DECIMAL(16,2)) AS split_original_amount,
       CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_discount AS DECIMAL(16,2)) AS DECIMAL(16,2)) AS split_activity_amount,
       CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_tax AS DECIMAL(16,2)) AS DECIMAL(16,2)) AS split_coupon_amount,
       CAST(CAST(l_extendedprice AS DECIMAL(16,2))
            - CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_discount AS DECIMAL(16,2)) AS DECIMAL(16,2))
            - CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_tax AS DECIMAL(16,2)) AS DECIMAL(16,2))
            AS DECIMAL(16,2)) AS split_total_amount,
       {LINEITEM_ARRIVAL_SQL}
FROM lineitem
"""


def epoch_ms(c) -> Column:
    return epoch_ms_of_ntz(c)


def window_sql(ts: str, seconds: int) -> str:
    """DuckDB text: start of the epoch-aligned tumbling window of ``seconds`` containing ``ts``."""
    w = seconds * 1_000_000
    return f"make_timestamp((epoch_us({ts}) // {w}) * {w})"


def window_cols_sql(ts: str, seconds: int) -> str:
    start = window_sql(ts, seconds)
    return (f"strftime({start}, '%Y-%m-%d %H:%M:%S') AS stt, "
            f"strftime({start} + INTERVAL {seconds} SECOND, '%Y-%m-%d %H:%M:%S') AS edt, "
            f"strftime({start}, '%Y-%m-%d') AS cur_date")


# ---- page log derived from `events` -------------------------------------------------
# Test-data mapping (not source-system values): search words shown for click rows.
SEARCH_WORDS = ["匡威帆布鞋", "衬衫", "心相印纸抽", "扫地机器人", "拯救者笔记本", "小米手机", "联想电脑", "维生素"]


def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat page log: one row per event with common fields, page fields and epoch-ms ``ts``.

    Error events carry no page (value < 10) or an empty page object; users
    whose id ends in 0 have no uid, in 1 an empty uid.
    """
    ev = table(spark, sf_dir, "events")
    uid, et, val, eid = F.col("user_id"), F.col("event_type"), F.col("value"), F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("bigint")

    def case(col, pairs, default=None):
        expr = None
        for v, out in pairs:
            expr = F.when(col == v, F.lit(out)) if expr is None else expr.when(col == v, F.lit(out))
        return expr.otherwise(F.lit(default)) if default is not None else expr

    words = F.array(*[F.lit(w) for w in SEARCH_WORDS])
    return ev.select(
        eid.alias("event_id"), uid.alias("user_id"), F.col("ts").alias("ts_ntz"), et.alias("event_type"),
        epoch_ms_of_ntz(F.col("ts")).alias("ts"),
        F.concat(F.lit("mid_"), uid.cast("string")).alias("mid"),
        F.when(uid % 10 == 0, F.lit(None).cast("string")).when(uid % 10 == 1, F.lit(""))
         .otherwise(uid.cast("string")).alias("uid"),
        F.when(eid % 3 == 0, F.lit("1")).otherwise(F.lit("0")).alias("is_new"),
        (uid % 7).cast("string").alias("ar"),
        case(uid % 4, [(0, "xiaomi"), (1, "oppo"), (2, "web")], "appstore").alias("ch"),
        F.concat(F.lit("v2.1."), (uid % 3).cast("string")).alias("vc"),
        case(uid % 5, [(0, "iOS 13.3.1"), (1, "Android 11.0"), (2, "Android"), (3, "HarmonyOS 3.0")], "iOS").alias("os"),
        F.concat(F.lit("model_"), (uid % 6).cast("string")).alias("md"),
        case(uid % 3, [(0, "Xiaomi"), (1, "iPhone")], "Huawei").alias("ba"),
        F.concat(F.lit("sid_"), uid.cast("string"), F.lit("_"), (eid.cast("bigint") / 50).cast("bigint").cast("string"))
         .alias("sid"),
        ((et != "error") | (val >= 10)).alias("has_page"),
        case(et, [("view", "good_detail"), ("click", "good_list"), ("purchase", "payment"), ("signup", "register")])
        .alias("page_id"),
        F.when(et == "click", F.lit("search")).when(et == "error", F.lit(None).cast("string"))
         .when(val < 5, F.lit(None).cast("string")).otherwise(F.lit("home")).alias("last_page_id"),
        F.when(et == "click", F.element_at(words, (k % len(SEARCH_WORDS) + 1).cast("int")))
         .when(et.isin("view", "purchase"), k.cast("string")).alias("item"),
        F.when(et == "click", F.lit("keyword")).when(et.isin("view", "purchase"), F.lit("sku_id")).alias("item_type"),
        F.when(et == "error", F.lit(None).cast("bigint"))
         .otherwise((val.cast("decimal(12,2)") * 1000).cast("bigint")).alias("during_time"),
        val.alias("value"), k.alias("k"))


def page_log_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page log as JSON text (``value``), keyed by ``event_id``; null fields omitted."""
    flat = page_log(spark, sf_dir)
    common = F.struct(*[F.col(c) for c in ("ar", "ba", "ch", "is_new", "md", "mid", "os", "sid", "uid", "vc")])
    page = F.when(F.col("has_page"), F.struct("page_id", "last_page_id", "item", "item_type", "during_time"))
    return flat.select("event_id", F.to_json(F.struct(common.alias("common"), page.alias("page"), "ts")).alias("value"))


_WORDS_SQL = "[" + ", ".join(f"'{w}'" for w in SEARCH_WORDS) + "]"
PAGE_LOG_SQL = f"""
SELECT event_id, user_id, ts AS ts_ntz, event_type, epoch_us(ts) // 1000 AS ts,
       'mid_' || CAST(user_id AS VARCHAR) AS mid,
       CASE WHEN user_id % 10 = 0 THEN NULL WHEN user_id % 10 = 1 THEN '' ELSE CAST(user_id AS VARCHAR) END AS uid,
       CASE WHEN event_id % 3 = 0 THEN '1' ELSE '0' END AS is_new,
       CAST(user_id % 7 AS VARCHAR) AS ar,
       CASE user_id % 4 WHEN 0 THEN 'xiaomi' WHEN 1 THEN 'oppo' WHEN 2 THEN 'web' ELSE 'appstore' END AS ch,
       'v2.1.' || CAST(user_id % 3 AS VARCHAR) AS vc,
       CASE user_id % 5 WHEN 0 THEN 'iOS 13.3.1' WHEN 1 THEN 'Android 11.0' WHEN 2 THEN 'Android'
            WHEN 3 THEN 'HarmonyOS 3.0' ELSE 'iOS' END AS os,
       'model_' || CAST(user_id % 6 AS VARCHAR) AS md,
       CASE user_id % 3 WHEN 0 THEN 'Xiaomi' WHEN 1 THEN 'iPhone' ELSE 'Huawei' END AS ba,
       'sid_' || CAST(user_id AS VARCHAR) || '_' || CAST(event_id // 50 AS VARCHAR) AS sid,
       (event_type <> 'error' OR value >= 10) AS has_page,
       CASE event_type WHEN 'view' THEN 'good_detail' WHEN 'click' THEN 'good_list' WHEN 'purchase' THEN 'payment'
            WHEN 'signup' THEN 'register' END AS page_id,
       CASE WHEN event_type = 'click' THEN 'search' WHEN event_type = 'error' THEN NULL WHEN value < 5 THEN NULL
            ELSE 'home' END AS last_page_id,
       CASE WHEN event_type = 'click' THEN {_WORDS_SQL}[CAST(json_extract_string(props, '$.k') AS BIGINT) % {len(SEARCH_WORDS)} + 1]
            WHEN event_type IN ('view', 'purchase') THEN CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) AS VARCHAR)
            END AS item,
       CASE WHEN event_type = 'click' THEN 'keyword' WHEN event_type IN ('view', 'purchase') THEN 'sku_id' END AS item_type,
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(CAST(value AS DECIMAL(12,2)) * 1000 AS BIGINT) END AS during_time,
       value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM events
"""


# ---- change envelopes replayed from the tables ---------------------------------------
def order_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``order_info`` envelopes: status O -> insert, F -> update from status O (the old image is
    absent for priority-1 orders), P -> snapshot read."""
    from tidemart.operators.routing import build_envelopes
    o = table(spark, sf_dir, "orders")
    ms = epoch_ms_of_ntz(F.col("o_orderdate"))
    op = F.when(F.col("o_orderstatus") == "O", "c").when(F.col("o_orderstatus") == "F", "u").otherwise("r")
    after = {"id": F.col("o_orderkey"), "user_id": F.col("o_custkey"), "total_amount": money("o_totalprice"),
             "order_status": F.col("o_orderstatus"), "create_time": ms}
    before = F.when((op == "u") & ~F.col("o_orderpriority").startswith("1-"),
                    F.create_map(F.lit("order_status"), F.lit("O")))
    return build_envelopes(o, "shop", "order_info", op, ms, after, before)


def customer_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_info`` snapshot envelopes from ``customer``."""
    from tidemart.operators.routing import build_envelopes
    c = table(spark, sf_dir, "customer")
    after = {"id": F.col("c_custkey"), "name": F.col("c_name"), "nation_id": F.col("c_nationkey"),
             "segment": F.col("c_mktsegment"), "balance": money("c_acctbal")}
    return build_envelopes(c, "shop", "user_info", F.lit("r"), F.lit(0).cast("bigint"), after, None)


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed of inserts of ``order_detail``, ``order_info``, ``order_detail_activity`` and ``order_detail_coupon``.

    A detail is a line item with its part's price; a detail has an activity where its largest discount is 8 % or more
    and a coupon where its least tax is 1 % or less.
    """
    from tidemart.operators.routing import build_envelopes
    li, orders, part = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "part"))
    created = epoch_ms_of_ntz(F.col("o_orderdate"))
    line = detail_id("l_orderkey", "l_linenumber")
    # The details' fields are made, as text, before the rows meet their orders: the optimizer then takes a field read from
    # the map for its column, so projections carry no map, and rows dealt by the text of the order key (the field
    # ``order_id``) need no further shuffle to meet their headers.
    lines = li.join(part.select("p_partkey", "p_name", "p_retailprice"), li.l_partkey == part.p_partkey).select(
        line.alias("id"), F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_partkey").cast("string").alias("sku_id"), F.col("p_name").alias("sku_name"),
        F.col("l_quantity").cast("bigint").cast("string").alias("sku_num"),
        money("p_retailprice").cast("string").alias("order_price"),
        money("l_extendedprice").cast("string").alias("split_total_amount"))
    made = orders.select(F.col("o_orderkey").cast("string").alias("made_id"), created.cast("string").alias("create_time"))
    rows = lines.join(made, F.col("order_id") == F.col("made_id"))
    details = build_envelopes(rows, "shop", "order_detail", F.lit("c"), F.col("create_time"), {
        c: F.col(c) for c in ("id", "order_id", "sku_id", "sku_name", "create_time", "sku_num", "order_price",
                              "split_total_amount")})
    headers = build_envelopes(orders, "shop", "order_info", F.lit("c"), created, {
        "id": F.col("o_orderkey"), "user_id": F.col("o_custkey")})
    # rows below 8 % can't be the largest where one reaches it (and so for the least tax): they stay out of the shuffles
    largest = li.where("l_discount >= 0.08").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_discount").alias("d"))
    least = li.where("l_tax <= 0.01").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_tax").alias("t"))
    pct = lambda c: (F.col(c).cast("decimal(4,2)") * 100).cast("int")
    activities = build_envelopes(largest, "shop", "order_detail_activity", F.lit("c"), F.lit(0), {
        "id": line, "order_detail_id": line, "activity_id": F.concat(F.lit("act_"), pct("d").cast("string")),
        "activity_rule_id": F.concat(F.lit("rule_"), (pct("d") % 3).cast("string"))})
    coupons = build_envelopes(least, "shop", "order_detail_coupon", F.lit("c"), F.lit(0), {
        "id": line, "order_detail_id": line, "coupon_id": F.concat(F.lit("cpn_"), pct("t").cast("string"))})
    return details.unionByName(headers).unionByName(activities).unionByName(coupons)


def refund_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``order_refund_info`` changes: an insert for every returned line item, and an update to the paid status for those
    whose line status is F."""
    from tidemart.operators.routing import build_envelopes
    li = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    after = {"id": detail_id("l_orderkey", "l_linenumber"), "order_id": F.col("l_orderkey"), "sku_id": F.col("l_partkey"),
             "refund_type": F.concat(F.lit("type_"), (F.col("l_linenumber") % 3).cast("string")),
             "refund_num": F.col("l_quantity").cast("int"), "refund_amount": money("l_extendedprice"),
             "refund_reason_type": F.concat(F.lit("reason_"), (F.col("l_partkey") % 4).cast("string"))}
    made = build_envelopes(li, "shop", "order_refund_info", F.lit("c"), epoch_ms_of_ntz(F.col("l_shipdate")), after)
    paid = build_envelopes(li.where(F.col("l_linestatus") == "F"), "shop", "order_refund_info", F.lit("u"),
                           epoch_ms_of_ntz(F.col("l_shipdate")), {**after, "refund_status": F.lit("1602")},
                           {"refund_status": F.lit("0701")})
    return made.unionByName(paid)


ORDER_DATE_MS_SQL = "(epoch_us(o_orderdate) // 1000)"


def customer_birthday_day() -> Column:
    """Derived birthday (epoch day) of a customer: 1972..2010."""
    return (F.lit(1000) + (F.col("c_custkey") * 7919) % 14000).cast("int")


CUSTOMER_BIRTHDAY_SQL = "CAST(1000 + (c_custkey * 7919) % 14000 AS INTEGER)"
