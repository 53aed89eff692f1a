"""The order-detail feed on tables of its own: brute force, and what its joins shuffle."""

import datetime
import os

from tidemart.plans import QUERIES

LINE = "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double"
LINES = [(1, 7, 1, 2.0, 10.5, 0.08, 0.02), (1, 7, 1, 3.0, 11.25, 0.01, 0.01), (1, 8, 2, 4.0, 12.0, 0.07, 0.0),
         (2, 7, 1, 5.0, 13.0, None, None), (2, 9, 2, 6.0, 14.0, 0.1, 0.01), (3, 7, 1, 7.0, 15.0, 0.09, 0.0),
         (None, 7, 1, 8.0, 16.0, 0.09, 0.0), (1, None, 3, 9.0, 17.0, 0.1, 0.0), (2, 8, None, None, None, 0.08, 0.005),
         (2, 8, 4, 1.0, 18.0, float("nan"), float("nan"))]
DAY = datetime.datetime(1996, 1, 2)
ORDERS = [(1, 100, DAY), (2, None, DAY), (2, 101, DAY), (None, 102, DAY)]
PARTS = [(7, "seven", 900.1), (8, None, None), (8, "eight", 2.5), (None, "none", 1.0)]


def write_tables(spark, scratch):
    for name, rows, schema in (("lineitem", LINES, LINE), ("orders", ORDERS, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
                               ("part", PARTS, "p_partkey long, p_name string, p_retailprice double")):
        spark.createDataFrame(rows, schema).write.parquet(os.path.join(scratch, f"{name}.parquet"))


def expected():
    line_id = lambda o, n: "_".join(str(x) for x in (o, n) if x is not None)
    marks = {}
    for o, _, n, _, _, d, t in LINES:
        m = marks.setdefault((o, n), ([], []))
        m[0].append(float("-inf") if d is None else float("inf") if d != d else d)
        m[1].append(float("inf") if t is None or t != t else t)
    acts, cpns = {}, {}
    for (o, n), (ds, ts) in marks.items():
        if max(ds) >= 0.08:
            pct = None if max(ds) == float("inf") else round(max(ds) * 100)
            acts.setdefault(line_id(o, n), []).append((pct and f"act_{pct}", pct and f"rule_{pct % 3}"))
        if min(ts) <= 0.01:
            cpns.setdefault(line_id(o, n), []).append(f"cpn_{int(round(min(ts), 2) * 100 + 1e-9)}")
    out = []
    for o, p, n, q, *_ in LINES:
        for ok, cust, _ in ORDERS:
            for ok2, user, _ in ORDERS:
                for pk, name, price in PARTS:
                    if o is not None and o == ok == ok2 and p is not None and p == pk:
                        amount = None if None in (q, price) else f"{q * price:.4f}"
                        for a in acts.get(line_id(o, n), [(None, None)]):
                            for c in cpns.get(line_id(o, n), [None]):
                                out.append((line_id(o, n), o, user, p, name, *a, c, amount))
    return sorted(out, key=str)


def test_order_feed_matches_brute_force_and_shuffles_its_lines_three_times(spark, scratch):
    write_tables(spark, scratch)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["order_detail_feed"](spark, scratch)
        plan = df._jdf.queryExecution().executedPlan().toString()
        got = [(r.id, r.order_id, r.user_id, r.sku_id, r.sku_name, r.activity_id, r.activity_rule_id, r.coupon_id,
                r.split_original_amount) for r in df.collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(got, key=str) == expected()
    # lines by part, by order (headers meet there too), by id; seven more deal parts, orders, headers, the marks' two
    # aggregates and their rows by id
    assert plan.count("Exchange hashpartitioning") == 10
    assert "Filter (isnotnull(l_discount" in plan and "Filter (isnotnull(l_tax" in plan  # before the aggregates
