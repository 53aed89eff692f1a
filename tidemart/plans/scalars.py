"""Scalar-function queries (S1-S35) over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.functions.dates import (age_on, date_of_epoch_day, date_text_to_ms, datetime_text_to_ms, day_bucket_of,
                                      decade_of, format_date, local_from_epoch_ms, ms_to_date, ms_to_datetime,
                                      ms_to_partition_day, star_sign)
from tidemart.functions.hashing import hash_mod, hash_mod_128, hash_mod_with_overrides
from tidemart.functions.hexdata import append_to_json_list, day_partition_range, hex_or_decimal_text, hex_words
from tidemart.functions.strings import (capitalise_first, is_blank, is_empty, join_set, lowercase_first,
                                        matches_plain_text, repeat_char, to_csv, zeros)
from tidemart.functions.tags import (category1_group, first_of_list, first_word, keyword_class, price_level,
                                     time_type_of_hour)
from tidemart.plans.registry import query
from tidemart.plans.tables import CUSTOMER_BIRTHDAY_SQL, PAGE_LOG_SQL, customer_birthday_day, epoch_ms, page_log, table
from tidemart.plans.tags import _c1_sql, _price_sql, _time_type_sql

ASOF = "2025-05-14"
SHANGHAI = "Asia/Shanghai"


@query("date_functions", """
WITH e AS (SELECT event_id, ts, strftime(ts, '%Y-%m-%d %H:%M:%S') AS dt_text, epoch_us(ts) // 1000 AS ms FROM events)
SELECT event_id, dt_text,
       epoch_us(CAST(dt_text AS TIMESTAMP) - INTERVAL 8 HOUR) // 1000 AS s1_ms,
       epoch_us(CAST(substr(dt_text, 1, 10) AS TIMESTAMP) - INTERVAL 8 HOUR) // 1000 AS s2_ms,
       strftime(make_timestamp(ms * 1000) + INTERVAL 8 HOUR, '%Y-%m-%d') AS s3_date,
       strftime(make_timestamp(ms * 1000) + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS s4_datetime,
       strftime(make_timestamp(ms * 1000) + INTERVAL 8 HOUR, '%Y%m%d') AS s5_day,
       strftime(ts, '%Y/%m/%d') AS s6_text,
       strftime(make_timestamp((ms // 1000) * 1000000), '%Y-%m-%d') AS s7_date_utc
FROM e
""")
def date_functions(spark, sf_dir):
    """Text <-> epoch ms at a fixed +08:00 offset, epoch ms -> local date/time/partition text."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    e = ev.select("event_id", "ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("dt_text"),
                  epoch_ms("ts").alias("ms"))
    return e.select("event_id", "dt_text", datetime_text_to_ms(F.col("dt_text")).alias("s1_ms"),
                    date_text_to_ms(F.substring("dt_text", 1, 10)).alias("s2_ms"),
                    ms_to_date("ms", SHANGHAI).alias("s3_date"), ms_to_datetime("ms", SHANGHAI).alias("s4_datetime"),
                    ms_to_partition_day("ms", SHANGHAI).alias("s5_day"), format_date("ts", "yyyy/MM/dd").alias("s6_text"),
                    ms_to_date((F.col("ms") / 1000).cast("bigint") * 1000, "UTC").alias("s7_date_utc"))


def _star_sql(d):
    """Star sign by the last day of each, as one number month * 100 + day (written apart from the plan's ranges)."""
    last = ((119, "摩羯座"), (218, "水瓶座"), (320, "双鱼座"), (419, "白羊座"), (520, "金牛座"), (621, "双子座"), (722, "巨蟹座"),
            (822, "狮子座"), (922, "处女座"), (1023, "天秤座"), (1122, "天蝎座"), (1221, "射手座"))
    return "CASE " + " ".join(f"WHEN month({d}) * 100 + day({d}) <= {n} THEN '{name}'" for n, name in last) + " ELSE '摩羯座' END"


@query("profile_functions", f"""
WITH c AS (SELECT c_custkey, CAST(DATE '1970-01-01' + {CUSTOMER_BIRTHDAY_SQL} AS DATE) AS b FROM customer)
SELECT c_custkey, strftime(b, '%Y-%m-%d') AS birthday,
       CAST(year(DATE '{ASOF}') - year(b)
            - CASE WHEN month(DATE '{ASOF}') * 100 + day(DATE '{ASOF}') < month(b) * 100 + day(b) THEN 1 ELSE 0 END
            AS INTEGER) AS age,
       {_star_sql('b')} AS star_sign, CAST(year(b) - year(b) % 10 AS INTEGER) AS decade
FROM c
""")
def profile_functions(spark, sf_dir):
    """S9-S12/SCO3: birthday from an epoch day, age as of a fixed date, star sign, decade."""
    c = table(spark, sf_dir, "customer").select("c_custkey", date_of_epoch_day(customer_birthday_day()).alias("b"))
    return c.select("c_custkey", F.date_format("b", "yyyy-MM-dd").alias("birthday"), age_on("b", ASOF).alias("age"),
                    star_sign("b").alias("star_sign"), decade_of("b").alias("decade"))


@query("order_buckets", f"""
SELECT event_id, {_time_type_sql('hour(ts + INTERVAL 8 HOUR)')} AS time_type,
       {_price_sql('value * 100')} AS price_level,
       {_c1_sql("CASE event_type WHEN 'view' THEN '个护化妆' WHEN 'click' THEN '食品饮料、保健食品' ELSE event_type END")} AS c1_name
FROM events
""")
def order_buckets(spark, sf_dir):
    """Time-of-day class (Shanghai hour), price level, category-1 group."""
    ev = table(spark, sf_dir, "events")
    hour = F.hour(local_from_epoch_ms(epoch_ms("ts"), SHANGHAI))
    cat = F.when(F.col("event_type") == "view", "个护化妆").when(F.col("event_type") == "click", "食品饮料、保健食品") \
        .otherwise(F.col("event_type"))
    return ev.select("event_id", time_type_of_hour(hour).alias("time_type"),
                     price_level(F.col("value") * 100).alias("price_level"), category1_group(cat).alias("c1_name"))


@query("keyword_class", f"""
WITH p AS ({PAGE_LOG_SQL})
SELECT event_id, item AS keyword,
       CASE WHEN item LIKE '%匡威%' THEN '时尚与潮流' WHEN item LIKE '%衬衫%' OR item LIKE '%心相印纸抽%' THEN '性价比'
            WHEN item LIKE '%扫地机器人%' THEN '家庭与育儿' WHEN item LIKE '%拯救者%' OR item LIKE '%小米%' THEN '数码与科技'
            WHEN item LIKE '%联想%' THEN '学习与发展' ELSE '健康与养生' END AS search_class,
       split_part(os || ',' || ba, ',', 1) AS device_os, split_part(os, ' ', 1) AS os_name
FROM p WHERE item_type = 'keyword'
""")
def keyword_class_q(spark, sf_dir):
    """Search keyword class (first matching rule); device os = first of a comma list; os first word."""
    p = page_log(spark, sf_dir).where(F.col("item_type") == "keyword")
    return p.select("event_id", F.col("item").alias("keyword"), keyword_class(F.col("item")).alias("search_class"),
                    first_of_list(F.concat_ws(",", "os", "ba")).alias("device_os"), first_word(F.col("os")).alias("os_name"))


# S28 pattern for DuckDB (RE2 spells the ideograph range with \x{...}); same character set as PLAIN_TEXT_PATTERN.
_PLAIN_SQL = r'^[\x{4e00}-\x{9fa5}a-zA-Z0-9\[\]\-_+{}:：“<>`?!——+·~@#$%^&*(、，。；‘【】！@#￥%……&*（）)"]+$'


@query("string_functions", f"""
WITH c AS (SELECT *, CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 7 = 1 THEN NULL
                          WHEN c_custkey % 7 = 2 THEN ' ' || chr(9) || ' ' ELSE c_name END AS s,
                     CASE WHEN c_custkey % 3 = 0 THEN c_name || ' x' ELSE c_name END AS p
           FROM customer),
seg AS (SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS nation_segments
        FROM customer GROUP BY 1)
SELECT c.c_custkey, upper(substr(lower(c_name), 1, 1)) || substr(lower(c_name), 2) AS cap_first,
       lower(substr(c_name, 1, 1)) || substr(c_name, 2) AS low_first,
       repeat('0', CAST(c_custkey % 5 AS INTEGER)) AS zeros_text, repeat('x', CAST(c_custkey % 3 AS INTEGER)) AS x_text,
       coalesce(length(s) = 0, true) AS empty_flag, coalesce(length(trim(s, ' ' || chr(9))) = 0, true) AS blank_flag,
       regexp_full_match(p, '{_PLAIN_SQL}') AS plain_text,
       c_mktsegment || ', ' || c_name AS csv_text, seg.nation_segments
FROM c JOIN seg ON c.c_nationkey = seg.c_nationkey
""")
def string_functions(spark, sf_dir):
    """Set join, csv join, first-letter case, zeros/repeat, empty/blank tests, plain-text match."""
    cust = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    s = F.when(k % 7 == 0, "").when(k % 7 == 1, F.lit(None).cast("string")).when(k % 7 == 2, " \t ") \
        .otherwise(F.col("c_name"))
    p = F.when(k % 3 == 0, F.concat(F.col("c_name"), F.lit(" x"))).otherwise(F.col("c_name"))
    seg = cust.groupBy("c_nationkey").agg(join_set(F.collect_set("c_mktsegment")).alias("nation_segments"))
    rows = cust.select("c_custkey", "c_nationkey", capitalise_first(F.lower("c_name")).alias("cap_first"),
                       lowercase_first(F.col("c_name")).alias("low_first"), zeros((k % 5).cast("int")).alias("zeros_text"),
                       repeat_char("x", (k % 3).cast("int")).alias("x_text"), is_empty(s).alias("empty_flag"),
                       is_blank(s).alias("blank_flag"), matches_plain_text(p).alias("plain_text"),
                       to_csv(F.array("c_mktsegment", "c_name")).alias("csv_text"))
    return rows.join(seg, "c_nationkey").drop("c_nationkey")


def _hex3_sql(x):
    h = f"right(md5({x}), 3)"
    return ("((position(substr({h}, 1, 1) IN '0123456789abcdef') - 1) * 256 + "
            "(position(substr({h}, 2, 1) IN '0123456789abcdef') - 1) * 16 + "
            "(position(substr({h}, 3, 1) IN '0123456789abcdef') - 1))").format(h=h)


@query("hash_mod", f"""
WITH c AS (SELECT c_custkey, c_name, '0x' || lpad(CAST(c_custkey AS VARCHAR), 40, '0') AS addr FROM customer)
SELECT c_custkey, lpad(CAST({_hex3_sql('CAST(c_custkey AS VARCHAR)')} % 128 AS VARCHAR), 4, '0') AS key_bucket,
       lpad(CAST({_hex3_sql('c_name')} % 16 AS VARCHAR), 4, '0') AS name_bucket,
       CASE lower(addr) WHEN '0x0000000000000000000000000000000000000000' THEN '9001'
                        WHEN '0x0000000000000000000000000000000000000001' THEN '9006'
                        ELSE lpad(CAST({_hex3_sql('addr')} % 128 AS VARCHAR), 4, '0') END AS addr_bucket
FROM c
""")
def hash_mod_q(spark, sf_dir):
    """md5-suffix buckets (used to salt hot keys), with pinned buckets for known hot addresses."""
    c = table(spark, sf_dir, "customer")
    addr = F.concat(F.lit("0x"), F.lpad(F.col("c_custkey").cast("string"), 40, "0"))
    return c.select("c_custkey", hash_mod_128(F.col("c_custkey")).alias("key_bucket"),
                    hash_mod(F.col("c_name"), 16).alias("name_bucket"), hash_mod_with_overrides(addr).alias("addr_bucket"))


@query("day_range", """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d0, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INTEGER) AS d1
           FROM orders),
r AS (SELECT o_orderkey, list_transform(range(CAST(d0 AS TIMESTAMP), CAST(d1 AS TIMESTAMP) + INTERVAL 1 DAY, INTERVAL 1 DAY),
                                        lambda t: CAST(strftime(t, '%Y%m%d') AS INTEGER)) AS days FROM o)
SELECT o_orderkey, CAST(len(days) AS INTEGER) AS n_days, days[1] AS first_day, days[len(days)] AS last_day,
       array_to_string(days, ',') AS days_text
FROM r
""")
def day_range(spark, sf_dir):
    """Inclusive yyyymmdd ranges between two dates."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d0"))
    o = o.withColumn("d1", F.date_add("d0", (F.col("o_orderkey") % 5).cast("int")))
    r = o.select("o_orderkey", day_partition_range(F.col("d0"), F.col("d1")).alias("days"))
    return r.select("o_orderkey", F.size("days").alias("n_days"), F.element_at("days", 1).alias("first_day"),
                    F.element_at("days", -1).alias("last_day"),
                    F.array_join(F.transform("days", lambda x: x.cast("string")), ",").alias("days_text"))


@query("hex_words", """
WITH d AS (SELECT doc_id, md5(text) AS h1, md5(coalesce(lang, '') || text) AS h2 FROM documents),
x AS (SELECT doc_id, '0x' || h1 || h2 || CASE WHEN doc_id % 2 = 0 THEN h2 || h1 ELSE '' END || 'ab' AS data,
             '0x' || substr(h1, 1, 20) AS wide_hex, h1, h2 FROM d),
v AS (SELECT *, CAST(wide_hex AS HUGEINT) AS n FROM x)
SELECT doc_id,
       CASE WHEN doc_id % 2 = 0 THEN '0x' || h1 || h2 || ',0x' || h2 || h1 ELSE '0x' || h1 || h2 END AS words,
       '[' || h1 || ', ' || h2 || ']' AS hash_list,
       CAST(n AS VARCHAR) AS wide_decimal,
       CASE WHEN rtrim(lpad(CAST(n % 1000000000000000000 AS VARCHAR), 18, '0'), '0') = ''
            THEN CAST(n // 1000000000000000000 AS VARCHAR)
            ELSE CAST(n // 1000000000000000000 AS VARCHAR) || '.' || rtrim(lpad(CAST(n % 1000000000000000000 AS VARCHAR), 18, '0'), '0')
       END AS wide_units
FROM v
""")
def hex_words_q(spark, sf_dir):
    """64-char words of a hex payload, JSON hash-list append, wide hex -> exact decimal (and / 1e18)."""
    d = table(spark, sf_dir, "documents").select(
        "doc_id", F.md5("text").alias("h1"), F.md5(F.concat(F.coalesce("lang", F.lit("")), "text")).alias("h2"))
    data = F.concat(F.lit("0x"), "h1", "h2", F.when(F.col("doc_id") % 2 == 0, F.concat("h2", "h1")).otherwise(F.lit("")),
                    F.lit("ab"))
    wide = F.concat(F.lit("0x"), F.substring("h1", 1, 20))
    return d.select("doc_id", F.array_join(hex_words(data), ",").alias("words"),
                    append_to_json_list(F.to_json(F.array("h1")), F.col("h2")).alias("hash_list"),
                    hex_or_decimal_text(wide).alias("wide_decimal"),
                    hex_or_decimal_text(wide, divide=True).alias("wide_units"))


@query("day_bucket", """
WITH e AS (SELECT event_id, CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 2 = 0 THEN epoch_us(ts) // 1000000
                                 ELSE epoch_us(ts) // 1000 END AS v FROM events)
SELECT event_id, v AS epoch_value,
       coalesce(strftime(make_timestamp((CASE WHEN v < 10000000000 THEN v * 1000 ELSE v END) * 1000), '%Y%m%d'),
                'error_bucket') AS day
FROM e
""")
def day_bucket(spark, sf_dir):
    """S35/SNK6: file-sink day bucket from an epoch that may be seconds or ms; null -> error bucket (UTC)."""
    ev = table(spark, sf_dir, "events").select("event_id", epoch_ms("ts").alias("ms"))
    eid = F.col("event_id")
    v = F.when(eid % 13 == 0, F.lit(None).cast("bigint")).when(eid % 2 == 0, (F.col("ms") / 1000).cast("bigint")) \
        .otherwise(F.col("ms"))
    return ev.select("event_id", v.alias("epoch_value")).select("event_id", "epoch_value",
                                                                day_bucket_of(F.col("epoch_value"), "UTC").alias("day"))
