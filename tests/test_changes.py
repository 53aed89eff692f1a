"""Fact projections over change envelopes (PRJ9, PRJ10, PRJ12)."""

from tidemart.operators.routing import (detail_activities, detail_coupons, order_details, order_headers,
                                        refund_requests, refunds_moved)
from tidemart.schemas import ENVELOPE


def envelope(table, op, after, before=None, ts=5):
    return (before, after, {"db": "shop", "table": table, "ts_ms": str(ts)}, op, ts)


def feed(spark):
    detail = {"id": "1", "order_id": "9", "sku_id": "7", "sku_num": "3", "order_price": "19.99", "split_total_amount": "59.97"}
    refund = {"id": "5", "order_id": "9", "sku_id": "7", "refund_num": "1", "refund_status": "0702"}
    return spark.createDataFrame([
        envelope("order_detail", "c", detail), envelope("order_detail", "r", {**detail, "id": "2"}),
        envelope("order_detail", "u", {**detail, "id": "3"}), envelope("order_detail", "c", {"id": "4", "sku_num": "x"}),
        envelope("order_info", "c", {"id": "9", "user_id": "u", "province_id": "p"}),
        envelope("order_detail_activity", "c", {"id": "1", "order_detail_id": "1", "activity_id": "a", "activity_rule_id": "r"}),
        envelope("order_detail_coupon", "c", {"id": "1", "order_detail_id": "1", "coupon_id": "c"}),
        envelope("order_refund_info", "c", refund), envelope("order_refund_info", "u", refund, {"refund_status": "0701"}),
        envelope("order_refund_info", "u", refund, {"refund_num": "2"}),
        envelope("order_refund_info", "u", {**refund, "refund_status": "0705"}, {"refund_status": "0701"})], ENVELOPE)


def test_order_projections(spark):
    env = feed(spark)
    got = {r.id: r for r in order_details(env).collect()}
    assert set(got) == {"1", "4"} and got["1"].split_original_amount == "59.9700" and got["1"].ts_ms == "5"
    assert got["4"].split_original_amount is None and got["1"].source_id is None
    assert {r.id for r in order_details(env, insert_ops=("c", "r")).collect()} == {"1", "2", "4"}
    assert [tuple(r) for r in order_headers(env).collect()] == [("9", "u", "p")]
    assert [tuple(r) for r in detail_activities(env).collect()] == [("1", "1", "a", "r")]
    assert [tuple(r) for r in detail_coupons(env).collect()] == [("1", "1", "c")]


def test_refund_projections(spark):
    env = feed(spark)
    rows = refund_requests(env).collect()
    assert len(rows) == 1 and len(rows[0]) == 11 and (rows[0].refund_num, rows[0].refund_reason_txt) == ("1", None)
    assert [tuple(r) for r in refunds_moved(env, "0702").collect()] == [("9", "7", "1")]
