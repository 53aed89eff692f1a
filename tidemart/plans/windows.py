"""Windowed aggregates (DWS layer): province, SKU, cart, page view and keyword windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.functions.dates import local_from_epoch_ms
from tidemart.functions.tokenize import tokenize, tokenize_cjk
from tidemart.operators.joins import EnrichSpec, enrich
from tidemart.operators.logs import normalize_logs, search_keywords
from tidemart.operators.parse import parse_json_records
from tidemart.operators.scan import running_profile_records
from tidemart.operators.stateful import first_per_key, new_visitor_fix, retract_dedupe, retract_dedupe_ttl, visit_flags
from tidemart.operators.windows import daily_first, last_per_window, running_profile, window_aggregate
from tidemart.plans.registry import query
from tidemart.plans.tables import (DETAIL_AMOUNTS, DETAIL_KEY, LINEITEM_ARRIVAL, LINEITEM_ARRIVAL_SQL,
                                   ORDER_DETAILS_SQL, PAGE_LOG_SQL, TZ, detail_id, epoch_ms, from_cents, order_details,
                                   page_log, page_log_json, table, window_cols_sql, window_sql)
from tidemart.schemas import PAGE_LOG

PROVINCE_WINDOW_SECONDS = 7 * 86400

PROVINCE_WINDOW_SQL = f"""
WITH d AS ({ORDER_DETAILS_SQL}),
last AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY {LINEITEM_ARRIVAL_SQL.replace(',', ' DESC,')} DESC) AS rn
  FROM d),
per_order AS (SELECT order_id, sum(split_total_amount) AS total FROM last WHERE rn = 1 GROUP BY order_id)
SELECT {window_cols_sql('o.o_orderdate', PROVINCE_WINDOW_SECONDS)},
       c.c_nationkey AS province_id, n.n_name AS province_name,
       CAST(sum(p.total) AS DOUBLE) AS order_amount, count(DISTINCT p.order_id) AS order_count
FROM per_order p JOIN orders o ON p.order_id = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY ALL
"""


@query("province_window", PROVINCE_WINDOW_SQL)
def province_window(spark, sf_dir):
    """Flagship (STA4 -> AGG4 -> JON8): per 7-day window and province, order amount and distinct orders.

    Plan shape: the retraction stream's net per id (its last record, a
    ``max_by`` aggregate) is summed per order *before* any join (map-side
    partial aggregates), so the joins with orders and customer see one row per
    order instead of one per detail; province names are joined last, onto the
    aggregated rows.
    """
    details = order_details(spark, sf_dir).select(*DETAIL_KEY, "split_total_amount", *LINEITEM_ARRIVAL)
    # sums over the retraction stream only need each id's net contribution (its last record)
    stream = retract_dedupe(details, DETAIL_KEY, LINEITEM_ARRIVAL, ["split_total_amount"], net=True)
    per_order = stream.groupBy("order_id").agg(F.sum("split_total_amount").alias("total"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("province_id"))
    facts = (per_order.join(orders, per_order.order_id == orders.o_orderkey)
             .join(cust, orders.o_custkey == cust.c_custkey))
    agg = window_aggregate(facts, "o_orderdate", f"{PROVINCE_WINDOW_SECONDS} seconds", ["province_id"],
                           # one row per order after the pre-aggregation, and an order has one date and one
                           # province: a plain count is the exact distinct count, without a distinct-agg shuffle
                           [from_cents(F.sum("total")).alias("order_amount"),
                            F.count("order_id").alias("order_count")], tz=TZ)
    nation = table(spark, sf_dir, "nation")
    named = enrich(agg, EnrichSpec(nation, "province_id", "n_nationkey", {"n_name": "province_name"}))
    return named.select("stt", "edt", "cur_date", "province_id", "province_name", "order_amount", "order_count")


RETRACT_TTL_MS = 730 * 86400 * 1000
_DESC = LINEITEM_ARRIVAL_SQL.replace(",", " DESC,") + " DESC"


@query("retract_dedupe", f"""
WITH d AS ({ORDER_DETAILS_SQL}),
r AS (SELECT id, split_total_amount AS amt, epoch_us(l_shipdate) // 1000 AS t,
             row_number() OVER (PARTITION BY id ORDER BY {_DESC}) AS rn_desc,
             lag(split_total_amount) OVER (PARTITION BY id ORDER BY {LINEITEM_ARRIVAL_SQL}) AS prev_amt,
             lag(epoch_us(l_shipdate) // 1000) OVER (PARTITION BY id ORDER BY {LINEITEM_ARRIVAL_SQL}) AS prev_t
      FROM d)
SELECT 'plain' AS variant, id, 1 AS sign, CAST(amt AS DOUBLE) AS split_total_amount FROM r
UNION ALL SELECT 'plain', id, -1, CAST(-amt AS DOUBLE) FROM r WHERE rn_desc > 1
UNION ALL SELECT 'ttl', id, 1, CAST(amt AS DOUBLE) FROM r
UNION ALL SELECT 'ttl', id, -1, CAST(-prev_amt AS DOUBLE) FROM r WHERE prev_t IS NOT NULL AND t - prev_t <= {RETRACT_TTL_MS}
""")
def retract_dedupe_q(spark, sf_dir):
    """STA4/STA5/S22: the retraction stream of the detail feed, without and with a memory TTL
    (two years of ship time)."""
    d = order_details(spark, sf_dir).select(*DETAIL_KEY, "split_total_amount", *LINEITEM_ARRIVAL)
    plain = retract_dedupe(d, DETAIL_KEY, LINEITEM_ARRIVAL, ["split_total_amount"])
    d_t = d.withColumn("t_ms", epoch_ms("l_shipdate"))
    ttl = retract_dedupe_ttl(d_t, DETAIL_KEY, LINEITEM_ARRIVAL, ["split_total_amount"], "t_ms", RETRACT_TTL_MS)
    pick = lambda df, v: df.select(F.lit(v).alias("variant"), detail_id().alias("id"), "sign",
                                   from_cents("split_total_amount").alias("split_total_amount"))
    return pick(plain, "plain").unionByName(pick(ttl, "ttl"))


SKU_WINDOW_SECONDS = 86400


@query("sku_window", f"""
WITH d AS ({ORDER_DETAILS_SQL}),
r AS (SELECT *, epoch_us(l_shipdate) // 1000 AS t,
             lag(split_original_amount) OVER w AS p_orig, lag(split_activity_amount) OVER w AS p_act,
             lag(split_coupon_amount) OVER w AS p_cpn, lag(split_total_amount) OVER w AS p_tot,
             lag(epoch_us(l_shipdate) // 1000) OVER w AS p_t, lag(sku_id) OVER w AS p_sku
      FROM d WINDOW w AS (PARTITION BY id ORDER BY {LINEITEM_ARRIVAL_SQL})),
s AS (SELECT order_id, sku_id, split_original_amount AS o, split_activity_amount AS a, split_coupon_amount AS c,
             split_total_amount AS tt FROM r
      UNION ALL SELECT order_id, p_sku, -p_orig, -p_act, -p_cpn, -p_tot FROM r
      WHERE p_t IS NOT NULL AND t - p_t <= {RETRACT_TTL_MS})
SELECT {window_cols_sql('ord.o_orderdate', SKU_WINDOW_SECONDS)}, s.sku_id, p.p_name AS sku_name, p.p_brand AS tm_name,
       CAST(sum(o) AS DOUBLE) AS original_amount, CAST(sum(a) AS DOUBLE) AS activity_amount,
       CAST(sum(c) AS DOUBLE) AS coupon_amount, CAST(sum(tt) AS DOUBLE) AS order_amount
FROM s JOIN orders ord ON s.order_id = ord.o_orderkey JOIN part p ON s.sku_id = p.p_partkey
GROUP BY ALL
""")
def sku_window(spark, sf_dir):
    """STA5 -> AGG3 -> JON7: per day and SKU, the four amounts after TTL retraction, with SKU names.

    The signed rows are summed per (order, sku) before the join with orders,
    and names are joined onto the aggregated rows.
    """
    d = order_details(spark, sf_dir).select(*DETAIL_KEY, "sku_id", *DETAIL_AMOUNTS, *LINEITEM_ARRIVAL)
    d = d.withColumn("t_ms", epoch_ms("l_shipdate"))
    stream = retract_dedupe_ttl(d, DETAIL_KEY, LINEITEM_ARRIVAL, DETAIL_AMOUNTS, "t_ms", RETRACT_TTL_MS)
    per = stream.groupBy("order_id", "sku_id").agg(*[F.sum(a).alias(a) for a in DETAIL_AMOUNTS])
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    facts = per.join(orders, per.order_id == orders.o_orderkey)
    agg = window_aggregate(facts, "o_orderdate", f"{SKU_WINDOW_SECONDS} seconds", ["sku_id"], [
        from_cents(F.sum("split_original_amount")).alias("original_amount"),
        from_cents(F.sum("split_activity_amount")).alias("activity_amount"),
        from_cents(F.sum("split_coupon_amount")).alias("coupon_amount"),
        from_cents(F.sum("split_total_amount")).alias("order_amount")], tz=TZ)
    named = enrich(agg, EnrichSpec(table(spark, sf_dir, "part"), "sku_id", "p_partkey",
                                   {"p_name": "sku_name", "p_brand": "tm_name"}))
    return named.select("stt", "edt", "cur_date", "sku_id", "sku_name", "tm_name", "original_amount",
                        "activity_amount", "coupon_amount", "order_amount")


@query("cart_uu_window", f"""
WITH c AS (SELECT user_id, ts, event_id, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'click'),
f AS (SELECT *, row_number() OVER (PARTITION BY user_id, d ORDER BY event_id) AS rn FROM c)
SELECT '10s' AS size, {window_cols_sql('ts', 10)}, count(*) AS cart_add_uu_ct FROM f WHERE rn = 1 GROUP BY ALL
UNION ALL
SELECT '1h', {window_cols_sql('ts', 3600)}, count(*) FROM f WHERE rn = 1 GROUP BY ALL
""")
def cart_uu_window(spark, sf_dir):
    """STA3 -> AGG1/AGG9/AGG10: unique cart users per tumbling window (first add per user and day)."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "click")
    adds = ev.select("user_id", "ts", "event_id", F.to_date("ts").alias("d"))
    firsts = first_per_key(adds, ["user_id", "d"], ["event_id"])
    out = None
    for label, size in (("10s", "10 seconds"), ("1h", "1 hour")):
        w = window_aggregate(firsts, "ts", size, [], [F.count(F.lit(1)).alias("cart_add_uu_ct")], tz=TZ)
        w = w.select(F.lit(label).alias("size"), "stt", "edt", "cur_date", "cart_add_uu_ct")
        out = w if out is None else out.unionByName(w)
    return out


_PAGES_SQL = f"""
WITH p AS ({PAGE_LOG_SQL}),
pg AS (SELECT *, CAST(ts_ntz AS DATE) AS d FROM p WHERE has_page),
fl AS (SELECT *, CASE WHEN lag(d) OVER (PARTITION BY mid ORDER BY ts, event_id) IS NULL
                        OR lag(d) OVER (PARTITION BY mid ORDER BY ts, event_id) <> d THEN 1 ELSE 0 END AS uv_ct,
              CASE WHEN last_page_id IS NULL OR last_page_id = '' THEN 1 ELSE 0 END AS sv_ct, 1 AS pv_ct
       FROM pg)"""


def _page_flags(spark, sf_dir):
    pages = page_log(spark, sf_dir).where("has_page").withColumn("d", F.to_date("ts_ntz"))
    return visit_flags(pages, "mid", ["ts", "event_id"], "d", "last_page_id")


@query("uv_sv_pv", _PAGES_SQL + """
SELECT event_id, mid, CAST(uv_ct AS BIGINT) AS uv_ct, CAST(sv_ct AS BIGINT) AS sv_ct, CAST(pv_ct AS BIGINT) AS pv_ct
FROM fl
""")
def uv_sv_pv(spark, sf_dir):
    """STA2: per page record, unique-visitor / session-start / page-view flags (an aggregate per device and day)."""
    return _page_flags(spark, sf_dir).select("event_id", "mid", "uv_ct", "sv_ct", "pv_ct")


@query("page_view_window", _PAGES_SQL + f"""
SELECT {window_cols_sql('ts_ntz', 3600)}, ar, ch, vc, is_new, CAST(sum(during_time) AS BIGINT) AS dur_sum,
       CAST(sum(pv_ct) AS BIGINT) AS pv_ct, CAST(sum(uv_ct) AS BIGINT) AS uv_ct, CAST(sum(sv_ct) AS BIGINT) AS sv_ct
FROM fl GROUP BY ALL
""")
def page_view_window(spark, sf_dir):
    """STA2 -> AGG2: per hour and (area, channel, version, is_new): stay time and pv/uv/sv sums."""
    flags = _page_flags(spark, sf_dir)
    return window_aggregate(flags, "ts_ntz", "1 hour", ["ar", "ch", "vc", "is_new"], [
        F.sum("during_time").cast("bigint").alias("dur_sum"), F.sum("pv_ct").cast("bigint").alias("pv_ct"),
        F.sum("uv_ct").cast("bigint").alias("uv_ct"), F.sum("sv_ct").cast("bigint").alias("sv_ct")], tz=TZ)


@query("keyword_window", rf"""
WITH t AS (SELECT make_timestamp(doc_id * 1000000) AS et,
                  unnest(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+')) AS keyword
           FROM documents)
SELECT {window_cols_sql('et', 10)}, keyword, count(*) AS keyword_count FROM t WHERE keyword <> '' GROUP BY ALL
""")
def keyword_window(spark, sf_dir):
    """UDF1/UDF2 -> AGG5: words of all documents (doc id as event seconds) counted per 10 s window."""
    docs = table(spark, sf_dir, "documents")
    words = docs.select(local_from_epoch_ms(F.col("doc_id") * 1000, "UTC").alias("et"),
                        F.explode(tokenize(F.col("text"))).alias("keyword"))
    return window_aggregate(words, "et", "10 seconds", ["keyword"], [F.count(F.lit(1)).alias("keyword_count")], tz=TZ)


@query("last_per_window", f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id, {window_sql('ts', 3600)} ORDER BY event_id DESC) AS rn
           FROM events)
SELECT user_id, {window_cols_sql('ts', 3600)}, event_id, event_type, value FROM r WHERE rn = 1
""")
def last_per_window_q(spark, sf_dir):
    """AGG6: the last record per user and hourly window."""
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    out = last_per_window(ev, "user_id", "ts", "1 hour", ["event_id"], tz=TZ)
    return out.select("user_id", "stt", "edt", "cur_date", "event_id", "event_type", "value")


@query("daily_first", """
WITH r AS (SELECT *, CAST(ts AS DATE) AS d, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id) AS rn
           FROM events),
f AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY d) AS prev_ts FROM r WHERE rn = 1)
SELECT user_id, strftime(d, '%Y-%m-%d') AS day, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text
FROM f WHERE prev_ts IS NULL OR ts >= prev_ts
""")
def daily_first_q(spark, sf_dir):
    """AGG8: first record per user and day, kept when not earlier than the previous day's first
    (a user's first day is emitted; ``emit_first=False`` gives the source behaviour)."""
    ev = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("d"), "event_id", "ts")
    out = daily_first(ev, "user_id", "d", ["event_id"], "ts")
    return out.select("user_id", F.date_format("d", "yyyy-MM-dd").alias("day"), "event_id",
                      F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts_text"))


@query("new_visitor_fix", f"""
WITH p AS ({PAGE_LOG_SQL}),
q AS (SELECT *, CAST(ts_ntz AS DATE) AS d FROM p),
f AS (SELECT mid, arg_min(CASE WHEN is_new = '1' THEN d ELSE d - 1 END, (ts, event_id)) AS state_d FROM q GROUP BY mid)
SELECT q.event_id, q.mid, q.is_new AS is_new_raw,
       CASE WHEN q.is_new = '1' AND f.state_d <> q.d THEN '0' ELSE q.is_new END AS is_new
FROM q JOIN f ON q.mid = f.mid
""")
def new_visitor_fix_q(spark, sf_dir):
    """STA1: repair of the new-visitor flag per device."""
    p = page_log(spark, sf_dir).select("event_id", "mid", "ts", "is_new", F.to_date("ts_ntz").alias("d"))
    fixed = new_visitor_fix(p.withColumn("is_new_raw", F.col("is_new")), "mid", ["ts", "event_id"], "d", "is_new")
    return fixed.select("event_id", "mid", "is_new_raw", "is_new")


@query("user_running_profile", f"""
WITH p AS ({PAGE_LOG_SQL}),
n AS (SELECT coalesce(nullif(uid, ''), '-1') AS uid, {window_sql('ts_ntz', 86400)} AS ws, split_part(os, ' ', 1) AS os, ch, md, ba,
             CASE WHEN item_type = 'keyword' THEN item ELSE '' END AS keyword
      FROM p WHERE has_page AND event_type <> 'error'),
c AS (SELECT uid, ws, count(*) AS n FROM n GROUP BY ALL),
run AS (SELECT uid, ws, sum(n) OVER (PARTITION BY uid ORDER BY ws ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS page_count FROM c),
fv AS (SELECT uid, 'os' AS f, os AS v, min(ws) AS first_ws FROM n GROUP BY ALL
       UNION ALL SELECT uid, 'ch', ch, min(ws) FROM n GROUP BY ALL
       UNION ALL SELECT uid, 'md', md, min(ws) FROM n GROUP BY ALL
       UNION ALL SELECT uid, 'ba', ba, min(ws) FROM n GROUP BY ALL
       UNION ALL SELECT uid, 'keyword', keyword, min(ws) FROM n GROUP BY ALL),
sets AS (SELECT r.uid, r.ws, fv.f, string_agg(DISTINCT fv.v, ',' ORDER BY fv.v) AS s
         FROM run r JOIN fv ON r.uid = fv.uid AND fv.first_ws <= r.ws GROUP BY ALL)
SELECT r.uid, CAST(r.page_count AS BIGINT) AS page_count,
       max(CASE WHEN f = 'os' THEN s END) AS os_set, max(CASE WHEN f = 'ch' THEN s END) AS ch_set,
       max(CASE WHEN f = 'md' THEN s END) AS md_set, max(CASE WHEN f = 'ba' THEN s END) AS ba_set,
       max(CASE WHEN f = 'keyword' THEN s END) AS keyword_set,
       strftime(r.ws, '%Y-%m-%d %H:%M:%S') AS stt, strftime(r.ws + INTERVAL 86400 SECOND, '%Y-%m-%d %H:%M:%S') AS edt,
       strftime(r.ws, '%Y-%m-%d') AS cur_date
FROM run r JOIN sets ON r.uid = sets.uid AND r.ws = sets.ws GROUP BY r.uid, r.ws, r.page_count
""")
def user_running_profile(spark, sf_dir):
    """AGG7 (fused with AGG6): running page count and running distinct os/ch/md/ba/keyword sets per
    user as of each daily window. The anonymous user '-1' is a key like any other (and a hot one)."""
    logs = parse_json_records(page_log_json(spark, sf_dir), PAGE_LOG, "value", mode="drop")
    flat = logs.select("data.*")
    norm = normalize_logs(flat, default_keyword="", keep=[F.col("common.ch").alias("ch"), F.col("common.md").alias("md"),
                                                          F.col("common.ba").alias("ba")])
    norm = norm.withColumn("et", local_from_epoch_ms(F.col("ts").cast("bigint"), "UTC"))
    out = running_profile(norm, "uid", "et", "1 day", ["os", "ch", "md", "ba", "keyword"], tz=TZ)
    return out


_PROFILE_FIELDS = ("os", "ch", "md", "ba", "keyword")


@query("user_profile_records", f"""
WITH p AS ({PAGE_LOG_SQL}),
n AS (SELECT event_id, coalesce(nullif(uid, ''), '-1') AS uid, ts, split_part(os, ' ', 1) AS os, ch, md, ba,
             CASE WHEN item_type = 'keyword' THEN item END AS keyword
      FROM p WHERE has_page AND event_type <> 'error'),
r AS (SELECT uid, event_id, row_number() OVER w AS page_count,
             {", ".join(f"list({f}) FILTER (WHERE {f} IS NOT NULL) OVER w AS {f}" for f in _PROFILE_FIELDS)}
      FROM n WINDOW w AS (PARTITION BY uid ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT uid, event_id, CAST(page_count AS BIGINT) AS page_count,
       {", ".join(f"coalesce(array_to_string(list_sort(list_distinct({f})), ','), '') AS {f}_set" for f in _PROFILE_FIELDS)}
FROM r
""")
def user_profile_records(spark, sf_dir):
    """AGG7, one row out per row in: running page count and running distinct os/ch/md/ba/keyword sets of every page
    record of a user in arrival order, by a prefix scan over ranges. The anonymous user '-1' is the hot key."""
    p = page_log(spark, sf_dir).where("has_page and event_type <> 'error'")
    flat = p.select("event_id", F.coalesce(F.nullif("uid", F.lit("")), F.lit("-1")).alias("uid"), "ts",
                    F.split_part("os", F.lit(" "), F.lit(1)).alias("os"), "ch", "md", "ba",
                    F.when(F.col("item_type") == "keyword", F.col("item")).alias("keyword"))
    out = running_profile_records(flat, "uid", ["ts", "event_id"], list(_PROFILE_FIELDS))
    return out.select("uid", "event_id", "page_count", *[f"{f}_set" for f in _PROFILE_FIELDS])


# Test-data segmentation dictionary for the search words (config, not source-system values).
SEARCH_DICTIONARY = ["匡威", "帆布鞋", "衬衫", "心相印", "纸抽", "扫地机器人", "拯救者", "笔记本", "小米", "手机", "联想",
                     "电脑", "维生素",
                     # words that cross the right borders: longest match from the left would take them
                     "小米手", "心相", "想电", "匡威帆", "衬", "扫地机", "机器人"]


# Expected segmentation of each search word by the dictionary above (best path), written out by hand
# for the oracle: DuckDB has no CJK segmenter, and these eight words are the only search items.
SEARCH_SEGMENTS = [("匡威帆布鞋", "匡威"), ("匡威帆布鞋", "帆布鞋"), ("衬衫", "衬衫"), ("心相印纸抽", "心相印"),
                   ("心相印纸抽", "纸抽"), ("扫地机器人", "扫地机器人"), ("拯救者笔记本", "拯救者"),
                   ("拯救者笔记本", "笔记本"), ("小米手机", "小米"), ("小米手机", "手机"), ("联想电脑", "联想"),
                   ("联想电脑", "电脑"), ("维生素", "维生素")]
_SEG_SQL = ", ".join(f"('{w}', '{t}')" for w, t in SEARCH_SEGMENTS)


@query("search_keyword_window", f"""
WITH p AS ({PAGE_LOG_SQL}),
seg(word, token) AS (VALUES {_SEG_SQL})
SELECT {window_cols_sql('p.ts_ntz', 10)}, seg.token AS keyword, count(*) AS keyword_count
FROM p JOIN seg ON p.item = seg.word
WHERE p.has_page AND p.last_page_id = 'search' AND p.item_type = 'keyword' AND p.item IS NOT NULL
GROUP BY ALL
""")
def search_keyword_window(spark, sf_dir):
    """PRJ14 -> UDF2 -> AGG5 (the source's keyword job): search-keyword rows of the page log, split
    into words by the best path through the dictionary's words, counted per 10 s window."""
    logs = parse_json_records(page_log_json(spark, sf_dir), PAGE_LOG, "value", mode="drop").select("data.*")
    logs = logs.withColumn("et", local_from_epoch_ms(F.col("ts"), "UTC"))
    rows = search_keywords(logs, "et")
    words = rows.select("et", F.explode(tokenize_cjk(F.col("full_word"), SEARCH_DICTIONARY)).alias("keyword"))
    return window_aggregate(words, "et", "10 seconds", ["keyword"], [F.count(F.lit(1)).alias("keyword_count")], tz=TZ)
