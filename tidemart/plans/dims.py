"""Dimension and sink queries: keyed upsert, cell-wise merge, deletes, scans, point reads, counts, renames."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.operators.stateful import last_per_key
from tidemart.plans.registry import query
from tidemart.plans.tables import (DETAIL_KEY, LINEITEM_ARRIVAL, LINEITEM_ARRIVAL_SQL, ORDER_DETAILS_SQL, detail_id,
                                   from_cents, money, order_details, table)
from tidemart.sources.dims import delete_keys, merge_cells, point_get_many, scan_limit, table_rows
from tidemart.sources.jdbc import rename_lower_camel

_DESC = LINEITEM_ARRIVAL_SQL.replace(",", " DESC,") + " DESC"


@query("upsert_latest", f"""
WITH d AS ({ORDER_DETAILS_SQL}),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {_DESC}) AS rn FROM d)
SELECT id, sku_id, CAST(split_total_amount AS DOUBLE) AS split_total_amount FROM r WHERE rn = 1
""")
def upsert_latest(spark, sf_dir):
    """SNK3: upsert semantics (last value per primary key wins) over the detail feed."""
    d = order_details(spark, sf_dir).select(*DETAIL_KEY, "sku_id", "split_total_amount", *LINEITEM_ARRIVAL)
    latest = last_per_key(d, DETAIL_KEY, LINEITEM_ARRIVAL)
    return latest.select(detail_id().alias("id"), "sku_id", from_cents("split_total_amount").alias("split_total_amount"))


def _customer_changes(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    none = F.lit(None).cast("string")
    e1 = c.select(k, F.lit(1).alias("seq"), F.lit("c").alias("op"), F.col("c_name").alias("name"),
                  F.col("c_nationkey").cast("string").alias("nation"), F.col("c_mktsegment").alias("segment"),
                  money("c_acctbal").cast("string").alias("balance"))
    e2 = c.where(k % 2 == 0).select(k, F.lit(2).alias("seq"), F.lit("u").alias("op"), F.lit("").alias("name"),
                                    none.alias("nation"), none.alias("segment"),
                                    (money("c_acctbal") + 1).cast("string").alias("balance"))
    e3 = c.where(k % 5 == 0).select(k, F.lit(3).alias("seq"), F.lit("d").alias("op"), none.alias("name"),
                                    none.alias("nation"), none.alias("segment"), none.alias("balance"))
    e4 = c.where(k % 10 == 0).select(k, F.lit(4).alias("seq"), F.lit("c").alias("op"), F.col("c_name").alias("name"),
                                     none.alias("nation"), F.lit("RESET").alias("segment"), none.alias("balance"))
    return e1.unionByName(e2).unionByName(e3).unionByName(e4)


@query("dim_merge", """
SELECT c_custkey, c_name AS name,
       CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS nation,
       CASE WHEN c_custkey % 10 = 0 THEN 'RESET' ELSE c_mktsegment END AS segment,
       CASE WHEN c_custkey % 10 = 0 THEN NULL
            WHEN c_custkey % 2 = 0 THEN CAST(CAST(c_acctbal AS DECIMAL(16,2)) + 1 AS VARCHAR)
            ELSE CAST(CAST(c_acctbal AS DECIMAL(16,2)) AS VARCHAR) END AS balance
FROM customer WHERE NOT (c_custkey % 5 = 0 AND c_custkey % 2 = 1)
""")
def dim_merge(spark, sf_dir):
    """SNK5: cell-wise merge of a dimension change feed (empty cells keep old values; deletes reset)."""
    changes = _customer_changes(spark, sf_dir)
    return merge_cells(changes, "c_custkey", ["seq"], ["name", "nation", "segment", "balance"])


@query("dim_delete_keys", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
""")
def dim_delete_keys(spark, sf_dir):
    """SNK8: delete a list of row keys (customers with a negative balance) from the dimension."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    deletes = cust.where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("k"))
    return delete_keys(cust.select("c_custkey", "c_name"), "c_custkey", deletes, "k")


@query("dim_scan_limit", """
SELECT CAST(c_custkey AS VARCHAR) AS row_key, c_name, c_nationkey, c_acctbal, c_mktsegment
FROM customer ORDER BY row_key LIMIT 100
""")
def dim_scan_limit(spark, sf_dir):
    """SRC12: a full scan with a row limit, in row-key order (the limit is the feature)."""
    return scan_limit(table(spark, sf_dir, "customer"), "c_custkey", 100)


@query("dim_point_get", """
SELECT CAST(c_custkey AS VARCHAR) AS row_key, c_name, c_nationkey FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
""")
def dim_point_get(spark, sf_dir):
    """SRC13: point reads by row key for a batch of requests (customers of urgent orders)."""
    cust = table(spark, sf_dir, "customer")
    wanted = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    got = point_get_many(cust, "c_custkey", wanted, "o_custkey")
    return got.select(F.col("c_custkey").cast("string").alias("row_key"), "c_name", "c_nationkey")


@query("table_rows", """
SELECT 'customer' AS table_name, count(*) AS n_rows FROM customer
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
""")
def table_rows_q(spark, sf_dir):
    """SNK9: row counts of tables."""
    parts = [table_rows(table(spark, sf_dir, t)).select(F.lit(t).alias("table_name"), "n_rows")
             for t in ("customer", "orders", "lineitem")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("rename_camel", """
SELECT c_custkey AS cCustkey, c_name AS cName, c_nationkey AS cNationkey, c_acctbal AS cAcctbal,
       c_mktsegment AS cMktsegment FROM customer
""")
def rename_camel(spark, sf_dir):
    """SRC11: rows with UPPER_UNDERSCORE-style names renamed to lowerCamel."""
    return rename_lower_camel(table(spark, sf_dir, "customer"))
