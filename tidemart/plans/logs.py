"""Log cleaning queries: parse with quarantine, page routing, normalising, JSON rows, word flags."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.tokenize import tokenize
from tidemart.operators.logs import normalize_logs
from tidemart.operators.parse import parse_json_records, route_pages, rows_to_json
from tidemart.operators.wordlist import flag_words
from tidemart.plans.registry import query
from tidemart.plans.tables import PAGE_LOG_SQL, page_log_json, table
from tidemart.schemas import PAGE_LOG

PROPS_SCHEMA = T.StructType([T.StructField("k", T.LongType())])


@query("parse_quarantine", """
WITH raw AS (
  SELECT event_id,
         CASE WHEN event_id % 7 = 0 THEN substr(props, 1, length(props) - 1)
              WHEN event_id % 11 = 0 THEN '[' || props || ']' ELSE props END AS v
  FROM events),
chk AS (SELECT event_id, v, CASE WHEN json_valid(v) THEN json_type(v) = 'OBJECT' ELSE false END AS ok FROM raw)
SELECT event_id, CASE WHEN ok THEN 'ok' ELSE 'bad' END AS status,
       CASE WHEN ok THEN CAST(json_extract(v, '$.k') AS BIGINT) END AS k
FROM chk
""")
def parse_quarantine(spark, sf_dir):
    """PRJ1/PRJ2: every 7th record truncated, every 11th wrapped in an array; valid/invalid split."""
    ev = table(spark, sf_dir, "events")
    eid, props = F.col("event_id"), F.col("props")
    raw = ev.select("event_id", F.when(eid % 7 == 0, F.expr("substr(props, 1, length(props) - 1)"))
                    .when(eid % 11 == 0, F.concat(F.lit("["), props, F.lit("]"))).otherwise(props).alias("value"))
    parsed = parse_json_records(raw, PROPS_SCHEMA, "value", mode="split")
    return parsed.select("event_id", F.when(F.col("is_valid"), "ok").otherwise("bad").alias("status"),
                         F.col("data.k").alias("k"))


@query("page_route", f"""
WITH p AS ({PAGE_LOG_SQL})
SELECT event_id, mid, page_id, last_page_id, item_type, during_time, ts FROM p WHERE has_page
""")
def page_route(spark, sf_dir):
    """PRJ5: parse the page-log JSON with the fixed schema; keep records that have a page object."""
    logs = parse_json_records(page_log_json(spark, sf_dir), PAGE_LOG, "value", mode="drop")
    pages = route_pages(logs.select("event_id", "data.*"))
    return pages.select("event_id", F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"),
                        F.col("page.last_page_id").alias("last_page_id"), F.col("page.item_type").alias("item_type"),
                        F.col("page.during_time").alias("during_time"), "ts")


@query("log_normalize", f"""
WITH p AS ({PAGE_LOG_SQL})
SELECT event_id, split_part(os, ' ', 1) AS os, CAST(ts AS VARCHAR) AS ts,
       CASE WHEN uid IS NULL OR uid = '' THEN '-1' ELSE uid END AS uid,
       CASE WHEN item_type = 'keyword' THEN item ELSE '' END AS keyword,
       coalesce(item_type = 'keyword', false) AS has_keyword,
       CASE WHEN uid IS NULL THEN 'ba,ch,md,mid,os,vc' ELSE 'ba,ch,md,mid,os,uid,vc' END AS info_keys,
       mid AS info_mid
FROM p WHERE has_page AND event_type <> 'error'
""")
def log_normalize(spark, sf_dir):
    """PRJ15/S17: non-empty common and page; os first word; uid or '-1'; keyword or default ''."""
    logs = parse_json_records(page_log_json(spark, sf_dir), PAGE_LOG, "value", mode="drop")
    flat = logs.select("event_id", "data.*")
    out = normalize_logs(flat, default_keyword="", keep=["event_id"])
    info = [f.name for f in out.schema["log_common_info"].dataType.fields]
    keys = F.concat_ws(",", *[F.when(F.col(f"log_common_info.{f}").isNotNull(), F.lit(f)) for f in sorted(info)])
    return out.select("event_id", "os", "ts", "uid", "keyword", "has_keyword", keys.alias("info_keys"),
                      F.col("log_common_info.mid").alias("info_mid"))


@query("to_json_rows", """
WITH c AS (SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS segment FROM customer)
SELECT '{"c_custkey":' || CAST(c_custkey AS VARCHAR) || ',"c_name":' || to_json(c_name)
       || CASE WHEN segment IS NULL THEN '' ELSE ',"segment":' || to_json(segment) END || '}' AS value,
       false AS keeps_nulls
FROM c
UNION ALL
SELECT '{"c_custkey":' || CAST(c_custkey AS VARCHAR) || ',"c_name":' || to_json(c_name)
       || ',"segment":' || coalesce(to_json(segment), 'null') || '}', true
FROM c
""")
def to_json_rows(spark, sf_dir):
    """PRJ16: customers as JSON text, once without nulls and once with them (integers and plain text
    only, so the text is the same in every engine)."""
    cust = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.when(F.col("c_acctbal") < 0, None).otherwise(F.col("c_mktsegment")).alias("segment"))
    a = rows_to_json(cust, keep_nulls=False, out="value")
    b = rows_to_json(cust, keep_nulls=True, out="value")
    return a.withColumn("keeps_nulls", F.lit(False)).unionByName(b.withColumn("keeps_nulls", F.lit(True)))


# Test-data word list for the membership check (config, not source-system values).
FLAG_WORDS = ["password", "secret", "token", "apikey", "ssn", "credit", "card", "bank", "account", "private",
              "confidential", "license", "copyright", "gpl", "mit", "email", "phone", "address", "the", "and"]
_FLAG_SQL = ", ".join(f"('{w}')" for w in FLAG_WORDS)


@query("word_flag", rf"""
WITH w(word) AS (VALUES {_FLAG_SQL}),
t AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+')) AS tok FROM documents),
h AS (SELECT d.doc_id, count(w.word) AS hit_count
      FROM documents d LEFT JOIN t ON d.doc_id = t.doc_id AND t.tok <> '' LEFT JOIN w ON t.tok = w.word
      GROUP BY d.doc_id)
SELECT doc_id, hit_count > 0 AS is_sensitive, hit_count FROM h
""")
def word_flag(spark, sf_dir):
    """PRJ17: per document, whether any token is in the word list, and how many tokens are."""
    docs = table(spark, sf_dir, "documents").select("doc_id", tokenize(F.col("text")).alias("tokens"))
    words = spark.createDataFrame([(w,) for w in FLAG_WORDS], "word string")
    return flag_words(docs, "doc_id", "tokens", words)
