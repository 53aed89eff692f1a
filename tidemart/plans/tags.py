"""Tag queries (DM layer): first/exact/pair dedupe, interval joins, weights, age inference, event time."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.functions.tags import (AGE_BRACKETS, BRAND_FALLBACK, DEVICE_FALLBACK, FACTOR_RATES, WEIGHTS,
                                     category1_group, first_of_list, first_word, keyword_class, price_level,
                                     time_type_of_hour)
from tidemart.operators.joins import EnrichSpec, enrich, interval_join
from tidemart.operators.logs import normalize_logs
from tidemart.operators.parse import parse_json_records
from tidemart.operators.scoring import FACTOR_ORDER, attach_weights, infer_age, prepare_weights, weight_columns, weight_table
from tidemart.operators.stateful import composite_dedupe, exact_dedupe, first_per_key
from tidemart.operators.windows import event_time_coalesce, event_time_seconds, last_per_window, window_start_of_batch
from tidemart.plans.registry import query
from tidemart.plans.tables import (CUSTOMER_BIRTHDAY_SQL, PAGE_LOG_SQL, TZ, cents, customer_birthday_day, epoch_ms,
                                   page_log, page_log_json, table, window_sql)
from tidemart.functions.dates import age_on, date_of_epoch_day, decade_of
from tidemart.schemas import PAGE_LOG

DAY_MS = 86400 * 1000
ASOF = "2025-05-14"  # fixed 'today' for ages, so results are stable


@query("first_per_user", """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)
SELECT user_id, event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text FROM r WHERE rn = 1
""")
def first_per_user(spark, sf_dir):
    """STA6: the first record per user, ever."""
    ev = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    first = first_per_key(ev, "user_id", ["event_id"])
    return first.select("user_id", "event_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts_text"))


@query("exact_dedupe", f"""
WITH p AS ({PAGE_LOG_SQL})
SELECT DISTINCT CASE WHEN uid IS NULL OR uid = '' THEN '-1' ELSE uid END AS uid, split_part(os, ' ', 1) AS os,
       CASE WHEN item_type = 'keyword' THEN item ELSE '' END AS keyword, mid AS info_mid, ch AS info_ch,
       md AS info_md, ba AS info_ba, vc AS info_vc, uid IS NOT NULL AS info_has_uid
FROM p WHERE has_page AND event_type <> 'error'
""")
def exact_dedupe_q(spark, sf_dir):
    """STA7: normalised log records without time, exact repeats dropped (the map column compared as JSON)."""
    logs = parse_json_records(page_log_json(spark, sf_dir), PAGE_LOG, "value", mode="drop").select("data.*")
    norm = normalize_logs(logs, default_keyword="").drop("ts", "has_keyword")
    uniq = exact_dedupe(norm)
    info = "log_common_info"
    return uniq.select("uid", "os", "keyword", F.col(f"{info}.mid").alias("info_mid"), F.col(f"{info}.ch").alias("info_ch"),
                       F.col(f"{info}.md").alias("info_md"), F.col(f"{info}.ba").alias("info_ba"),
                       F.col(f"{info}.vc").alias("info_vc"), F.col(f"{info}.uid").isNotNull().alias("info_has_uid"))


@query("composite_dedupe", """
WITH r AS (SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_id,
                  row_number() OVER (PARTITION BY user_id, json_extract_string(props, '$.k') ORDER BY event_id) AS rn
           FROM events)
SELECT user_id, k, event_id FROM r WHERE rn = 1
""")
def composite_dedupe_q(spark, sf_dir):
    """STA8 (exact form): first record per ``user_id + '_' + k`` pair."""
    ev = table(spark, sf_dir, "events").select("user_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"),
                                               "event_id")
    return composite_dedupe(ev, "user_id", "k", ["event_id"])


def _pairs_sql(days: int) -> str:
    return f"""
WITH l AS (SELECT user_id, event_id, epoch_us(ts) // 1000 AS t FROM events WHERE event_type = 'purchase'),
r AS (SELECT user_id, event_id, epoch_us(ts) // 1000 AS t FROM events WHERE event_type = 'click')
SELECT l.user_id, l.event_id AS left_event_id, r.event_id AS right_event_id, r.t - l.t AS gap_ms
FROM l JOIN r ON l.user_id = r.user_id AND r.t BETWEEN l.t - {days * DAY_MS} AND l.t + {days * DAY_MS}
"""


def _pairs(spark, sf_dir, days: int, cell_rows: int | None = None):
    ev = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", epoch_ms("ts").alias("t"))
    left = ev.where(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("l_user"), F.col("event_id").alias("left_event_id"), F.col("t").alias("l_t"))
    right = ev.where(F.col("event_type") == "click").select(
        F.col("user_id").alias("r_user"), F.col("event_id").alias("right_event_id"), F.col("t").alias("r_t"))
    j = interval_join(left, right, "l_user", "r_user", "l_t", "r_t", -days * DAY_MS, days * DAY_MS,
                      bucket_ms=days * DAY_MS, cell_rows=cell_rows)
    return j.select(F.col("l_user").alias("user_id"), "left_event_id", "right_event_id",
                    (F.col("r_t") - F.col("l_t")).alias("gap_ms"))


@query("interval_join", _pairs_sql(2))
def interval_join_q(spark, sf_dir):
    """JON10: purchases x clicks of the same user within +-2 days (inclusive)."""
    return _pairs(spark, sf_dir, 2)


@query("interval_join_wide", _pairs_sql(50))
def interval_join_wide(spark, sf_dir):
    """JON11: the same with a +-50 day bound; a heavy user's buckets are cut into grids of 4,000 x 4,000 rows."""
    return _pairs(spark, sf_dir, 50, cell_rows=4000)


@query("interval_join_grid", _pairs_sql(10))
def interval_join_grid(spark, sf_dir):
    """JON11 at a width that leaves pairs out (+-10 days), with small grid cells, so that users are cut here too."""
    return _pairs(spark, sf_dir, 10, cell_rows=8)


# ---- weights as DuckDB rows (same fixed values as tidemart.functions.tags.WEIGHTS) ----
_W_ROWS = ", ".join(f"('{f}', '{c}', CAST([{', '.join(str(x) for x in ws)}] AS DOUBLE[]))"
                    for f, cats in WEIGHTS.items() for c, ws in cats.items())
WEIGHTS_SQL = f"w(factor, category, w) AS (VALUES {_W_ROWS})"
_WTXT = "array_to_string(list_transform({0}, lambda x: CAST(x AS VARCHAR)), ',')"

# Test-data mapping of part attributes onto the source system's category and brand names.
CATEGORY1_OF_TYPE = {"PROMO": "个护化妆", "SMALL": "食品饮料、保健食品"}
BRAND_OF_PART = {"Brand#1": "小米", "Brand#2": "苹果", "Brand#3": "联想", "Brand#4": "金沙河"}


def _map_case(col, mapping):
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr.otherwise(col)


def _map_case_sql(col, mapping):
    return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items()) + f" ELSE {col} END"


def _c1_sql(col):
    return (f"CASE WHEN {col} = '个护化妆' THEN '潮流服饰' WHEN {col} = '食品饮料、保健食品' THEN '健康食品' "
            f"ELSE '家居用品' END")


def _time_type_sql(h):
    return (f"CASE WHEN {h} < 6 THEN '凌晨' WHEN {h} < 9 THEN '早晨' WHEN {h} < 12 THEN '上午' WHEN {h} < 14 THEN '中午' "
            f"WHEN {h} < 18 THEN '下午' WHEN {h} < 22 THEN '晚上' ELSE '夜间' END")


def _price_sql(a):
    return f"CASE WHEN {a} <= 1000 THEN '低价商品' WHEN {a} <= 3000 THEN '中价商品' WHEN {a} IS NOT NULL THEN '高价商品' END"


WEIGHT_LOOKUP_SQL = f"""
WITH {WEIGHTS_SQL},
b AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS id,
         {_time_type_sql('((o_orderkey * 7) % 24)')} AS time_type,
         {_price_sql('CAST(CAST(l_extendedprice AS DECIMAL(16,2)) / 10 AS DOUBLE)')} AS price_level,
         {_c1_sql(_map_case_sql('p_type', CATEGORY1_OF_TYPE))} AS c1_name,
         {_map_case_sql('p_brand', BRAND_OF_PART)} AS tm_name
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
SELECT b.id, b.time_type, b.price_level, b.c1_name, b.tm_name,
       {_WTXT.format('wt.w')} AS time_w, {_WTXT.format('wp.w')} AS price_w, {_WTXT.format('wc.w')} AS c1_w,
       {_WTXT.format('coalesce(wb.w, wf.w)')} AS tm_w
FROM b
LEFT JOIN w wt ON wt.factor = 'time' AND wt.category = b.time_type
LEFT JOIN w wp ON wp.factor = 'price' AND wp.category = b.price_level
LEFT JOIN w wc ON wc.factor = 'category' AND wc.category = b.c1_name
LEFT JOIN w wb ON wb.factor = 'brand' AND wb.category = b.tm_name
LEFT JOIN w wf ON wf.factor = 'brand' AND wf.category = '{BRAND_FALLBACK}'
"""


def _order_tags(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"),
        "l_orderkey", "l_partkey", "l_extendedprice")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(part, li.l_partkey == part.p_partkey)
    create_ms = epoch_ms("o_orderdate") + ((F.col("o_orderkey") * 7) % 24) * 3600 * 1000
    from tidemart.functions.dates import local_from_epoch_ms
    return j.select("id", time_type_of_hour(F.hour(local_from_epoch_ms(create_ms, TZ))).alias("time_type"),
                    price_level(cents("l_extendedprice") / 1000.0).alias("price_level"),
                    category1_group(_map_case(F.col("p_type"), CATEGORY1_OF_TYPE)).alias("c1_name"),
                    _map_case(F.col("p_brand"), BRAND_OF_PART).alias("tm_name"))


def _wtxt(prefix):
    """Six weight columns as comma-separated text."""
    return F.concat_ws(",", *[c.cast("string") for c in weight_columns(prefix)])


@query("weight_lookup", WEIGHT_LOOKUP_SQL)
def weight_lookup(spark, sf_dir):
    """JON13/SCO1/S13-S15: order-detail tags with their time, price, category and brand weights
    (unknown brands take the fallback brand's row)."""
    tags = _order_tags(spark, sf_dir)
    w = prepare_weights(weight_table(spark))
    tags = attach_weights(tags, w, "time", "time_type", out="time_w")
    tags = attach_weights(tags, w, "price", "price_level", out="price_w")
    tags = attach_weights(tags, w, "category", "c1_name", out="c1_w")
    tags = attach_weights(tags, w, "brand", "tm_name", fallback=BRAND_FALLBACK, out="tm_w")
    return tags.select("id", "time_type", "price_level", "c1_name", "tm_name", _wtxt("time_w").alias("time_w"),
                       _wtxt("price_w").alias("price_w"), _wtxt("c1_w").alias("c1_w"), _wtxt("tm_w").alias("tm_w"))


def _age_terms_sql():
    parts = []
    names = {"category": "wc", "brand": "coalesce(wb.w, wf.w)", "time": "wt", "price": "wp",
             "device": "coalesce(wd.w, wde.w)", "keyword": "wk"}
    for i in range(len(AGE_BRACKETS)):
        terms = []
        for f in FACTOR_ORDER:
            ref = names[f] if "(" in names[f] else f"{names[f]}.w"
            terms.append(f"coalesce(({ref})[{i + 1}], 0.0) * {FACTOR_RATES[f]}")
        parts.append(" + ".join(terms))
    return "[" + ", ".join(f"({p})" for p in parts) + ", 0.0]"


_BRACKETS_SQL = "[" + ", ".join(f"'{b}'" for b in AGE_BRACKETS) + f", '{AGE_BRACKETS[0]}']"

AGE_INFER_SQL = f"""
WITH {WEIGHTS_SQL},
p AS ({PAGE_LOG_SQL}),
o AS (SELECT p.user_id, p.event_id, p.ts, {window_sql('p.ts_ntz', 86400)} AS ws,
             {_time_type_sql('hour(p.ts_ntz)')} AS time_type,
             {_price_sql('p.value * 100')} AS price_level,
             {_c1_sql(_map_case_sql('pt.p_type', CATEGORY1_OF_TYPE))} AS c1_name,
             {_map_case_sql('pt.p_brand', BRAND_OF_PART)} AS tm_name
      FROM p JOIN part pt ON pt.p_partkey = p.k WHERE p.event_type = 'purchase'),
ol AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, ws ORDER BY event_id DESC) AS rn FROM o) WHERE rn = 1),
k AS (SELECT user_id, event_id, ts, {window_sql('ts_ntz', 86400)} AS ws,
             CASE WHEN item LIKE '%匡威%' THEN '时尚与潮流' WHEN item LIKE '%衬衫%' OR item LIKE '%心相印纸抽%' THEN '性价比'
                  WHEN item LIKE '%扫地机器人%' THEN '家庭与育儿' WHEN item LIKE '%拯救者%' OR item LIKE '%小米%' THEN '数码与科技'
                  WHEN item LIKE '%联想%' THEN '学习与发展' ELSE '健康与养生' END AS search,
             split_part(split_part(os, ',', 1), ' ', 1) AS device_os
      FROM p WHERE has_page AND event_type <> 'error' AND item_type = 'keyword'),
kl AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, ws ORDER BY event_id DESC) AS rn FROM k) WHERE rn = 1),
j AS (SELECT ol.user_id, ol.event_id AS order_event_id, kl.event_id AS keyword_event_id,
             ol.time_type, ol.price_level, ol.c1_name, ol.tm_name, kl.search, kl.device_os
      FROM ol JOIN kl ON ol.user_id = kl.user_id AND kl.ts BETWEEN ol.ts - {50 * DAY_MS} AND ol.ts + {50 * DAY_MS}),
s AS (SELECT j.user_id, j.order_event_id, j.keyword_event_id, {_age_terms_sql()} AS sums
      FROM j
      LEFT JOIN w wt ON wt.factor = 'time' AND wt.category = j.time_type
      LEFT JOIN w wp ON wp.factor = 'price' AND wp.category = j.price_level
      LEFT JOIN w wc ON wc.factor = 'category' AND wc.category = j.c1_name
      LEFT JOIN w wb ON wb.factor = 'brand' AND wb.category = j.tm_name
      LEFT JOIN w wf ON wf.factor = 'brand' AND wf.category = '{BRAND_FALLBACK}'
      LEFT JOIN w wd ON wd.factor = 'device' AND wd.category = j.device_os
      LEFT JOIN w wde ON wde.factor = 'device' AND wde.category = '{DEVICE_FALLBACK}'
      LEFT JOIN w wk ON wk.factor = 'keyword' AND wk.category = j.search)
SELECT s.user_id, order_event_id, keyword_event_id,
       {_BRACKETS_SQL}[list_position(sums, list_max(sums))] AS inferred_age,
       CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex,
       CAST(year(DATE '{ASOF}') - year(b) - CASE WHEN month(DATE '{ASOF}') * 100 + day(DATE '{ASOF}')
            < month(b) * 100 + day(b) THEN 1 ELSE 0 END AS INTEGER) AS age,
       CAST(year(b) - year(b) % 10 AS INTEGER) AS decade
FROM s JOIN (SELECT c_custkey, CAST(DATE '1970-01-01' + {CUSTOMER_BIRTHDAY_SQL} AS DATE) AS b FROM customer) cu
  ON s.user_id = cu.c_custkey
"""


@query("age_infer", AGE_INFER_SQL)
def age_infer(spark, sf_dir):
    """JON12/SCO1/SCO2/AGG6: latest order tags and latest keyword tags per user and day, joined
    within +-50 days, scored into an inferred age bracket."""
    p = page_log(spark, sf_dir)
    from tidemart.functions.dates import local_from_epoch_ms
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    buys = p.where(F.col("event_type") == "purchase").join(part, F.col("k") == part.p_partkey)
    orders = buys.select("user_id", "event_id", "ts", "ts_ntz",
                         time_type_of_hour(F.hour("ts_ntz")).alias("time_type"),
                         price_level(F.col("value") * 100).alias("price_level"),
                         category1_group(_map_case(F.col("p_type"), CATEGORY1_OF_TYPE)).alias("c1_name"),
                         _map_case(F.col("p_brand"), BRAND_OF_PART).alias("tm_name"))
    orders = last_per_window(orders, "user_id", "ts_ntz", "1 day", ["event_id"], tz=TZ)
    kw = p.where(F.col("has_page") & (F.col("event_type") != "error") & (F.col("item_type") == "keyword"))
    kw = kw.select("user_id", "event_id", "ts", "ts_ntz", keyword_class(F.col("item")).alias("search"),
                   first_word(first_of_list(F.col("os"))).alias("device_os"))
    kw = last_per_window(kw, "user_id", "ts_ntz", "1 day", ["event_id"], tz=TZ)
    w = prepare_weights(weight_table(spark))
    orders = attach_weights(orders, w, "time", "time_type", out="time_w")
    orders = attach_weights(orders, w, "price", "price_level", out="price_w")
    orders = attach_weights(orders, w, "category", "c1_name", out="category_w")
    orders = attach_weights(orders, w, "brand", "tm_name", fallback=BRAND_FALLBACK, out="brand_w")
    kw = attach_weights(kw, w, "keyword", "search", out="keyword_w")
    kw = attach_weights(kw, w, "device", "device_os", fallback=DEVICE_FALLBACK, out="device_w")
    lw = [c for p in ("time_w", "price_w", "category_w", "brand_w") for c in weight_columns(p)]
    rw = [c for p in ("keyword_w", "device_w") for c in weight_columns(p)]
    left = orders.select(F.col("user_id").alias("l_user"), F.col("event_id").alias("order_event_id"),
                         F.col("ts").alias("l_t"), *lw)
    right = kw.select(F.col("user_id").alias("r_user"), F.col("event_id").alias("keyword_event_id"),
                      F.col("ts").alias("r_t"), *rw)
    j = interval_join(left, right, "l_user", "r_user", "l_t", "r_t", -50 * DAY_MS, 50 * DAY_MS, bucket_ms=50 * DAY_MS)
    cols = {f: f"{f}_w" for f in FACTOR_ORDER}
    scored = j.select(F.col("l_user").alias("user_id"), "order_event_id", "keyword_event_id",
                      infer_age(cols).alias("inferred_age"))
    # final tag record: user attributes from the user dimension (D18: sex is the user's gender)
    users = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        date_of_epoch_day(customer_birthday_day()).alias("birthday"))
    users = users.select("c_custkey", "gender", age_on("birthday", ASOF).alias("age"), decade_of("birthday").alias("dec"))
    out = enrich(scored, EnrichSpec(users, "user_id", "c_custkey", {"gender": "sex", "age": "age", "dec": "decade"}))
    return out


@query("event_time_coalesce", """
SELECT event_id,
       coalesce(CASE WHEN event_id % 3 = 0 THEN epoch_us(ts) // 1000 END,
                CASE WHEN event_id % 3 = 1 THEN epoch_us(ts) // 1000 - 1 END, 0) AS t3,
       coalesce(CASE WHEN event_id % 2 = 0 THEN epoch_us(ts) // 1000000 END, epoch_us(ts) // 1000000 + 1) * 1000 AS t4,
       epoch_us(ts) // 60000000 * 60000 AS t5
FROM events
""")
def event_time_coalesce_q(spark, sf_dir):
    """TIM3/TIM4/TIM5: record times from JSON fields with fallbacks; batch element time from its first record."""
    ev = table(spark, sf_dir, "events").select("event_id", epoch_ms("ts").alias("ms"))
    eid, ms = F.col("event_id"), F.col("ms")
    rec = ev.select("event_id", F.to_json(F.struct(
        F.when(eid % 3 == 0, ms).alias("ts_ms"), F.when(eid % 3 == 1, ms - 1).alias("ts"),
        F.when(eid % 2 == 0, (ms / 1000).cast("bigint")).alias("block_timestamp"),
        ((ms / 1000).cast("bigint") + 1).alias("timestamp"),
        F.array(F.struct(((ms / 60000).cast("bigint") * 60000).alias("window_start_time"))).alias("records"))
    ).alias("value"))
    schema = ("ts_ms string, ts string, block_timestamp bigint, timestamp bigint, "
              "records array<struct<window_start_time:bigint>>")
    parsed = rec.select("event_id", F.from_json("value", schema).alias("r"))
    return parsed.select("event_id", event_time_coalesce(F.col("r.ts_ms"), F.col("r.ts")).alias("t3"),
                         event_time_seconds(F.col("r.block_timestamp"), F.col("r.timestamp")).alias("t4"),
                         window_start_of_batch(F.col("r.records")).alias("t5"))
