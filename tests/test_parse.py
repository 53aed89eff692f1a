"""JSON quarantine modes, page routing, envelope routing and JSON rows."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.operators.parse import parse_json_records, route_pages, rows_to_json, split_parsed
from tidemart.operators.routing import build_envelopes, cart_adds, filter_cdc, latest_rules, route_by_rules
from tidemart.schemas import PAGE_LOG

RAW = ['{"common":{"mid":"m1","os":"iOS 13"},"page":{"page_id":"a"},"ts":1}', '{"common":{"mid":"m2"},"ts":2}',
       '{"common":{"mid":"m3"},"page":{},"ts":3}', "{bad", "[1,2]", "7", None]


def test_modes(spark):
    df = spark.createDataFrame([(v,) for v in RAW], "value string")
    good, bad = split_parsed(parse_json_records(df, PAGE_LOG, mode="split"))
    assert good.count() == 3 and bad.count() == 4
    assert parse_json_records(df, PAGE_LOG, mode="drop").count() == 3
    assert parse_json_records(df, PAGE_LOG, mode="null").where("data is null").count() == 4
    pages = route_pages(parse_json_records(df, PAGE_LOG, mode="drop").select("data.*"))
    assert sorted(r.common.mid for r in pages.collect()) == ["m1", "m3"]   # an empty page object counts
    with pytest.raises(Exception):
        parse_json_records(df, PAGE_LOG, mode="fail").collect()


def test_repeated_keys_and_text_after_the_object(spark):
    raw = ['{"ts":1,"ts":5,"page":{"page_id":"a","page_id":"b"}}', ' {"ts":2}\n', '{"ts":3} junk', '{"ts":4', '{"ts":"6"}', '{"ts":"x"}', '[{"ts":7}]']
    got = parse_json_records(spark.createDataFrame([(v,) for v in raw], "value string"), PAGE_LOG, mode="split").collect()
    assert [(r.is_valid, r.data and r.data.ts) for r in got] == [
        (True, 5), (True, 2), (False, None), (False, None), (True, 6), (True, None), (False, None)]
    assert got[0].data.page.page_id == "b"


def test_flags_are_per_row(spark):
    from tidemart.operators.wordlist import flag_words, keep_flagged

    df = spark.createDataFrame([(1, ["a", "b"]), (1, ["c"]), (None, ["a", "a"]), (None, None), (2, []), (1, ["a", "b"])],
                               "k long, toks array<string>").repartition(3)
    words = spark.createDataFrame([("a",), ("a",), ("",), (None,)], "word string")
    got = sorted(map(tuple, flag_words(df, "k", "toks", words).collect()), key=repr)
    assert got == sorted([(1, True, 1), (1, False, 0), (None, True, 2), (None, False, 0), (2, False, 0), (1, True, 1)], key=repr)
    kept = sorted(map(tuple, keep_flagged(df, "k", "toks", words).collect()), key=repr)
    assert kept == sorted([(1, ["a", "b"]), (None, ["a", "a"]), (1, ["a", "b"])], key=repr)


def test_rows_to_json(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert rows_to_json(df).first().value == '{"a":1}'
    assert rows_to_json(df, keep_nulls=True).first().value == '{"a":1,"b":null}'


def test_routing_and_cart(spark):
    rows = spark.createDataFrame([(1, "c", 2, None), (2, "u", 5, 3), (3, "u", 1, 4), (4, "d", None, 1)],
                                 "id int, op string, new int, old int")
    env = build_envelopes(rows, "shop", "cart_info", F.col("op"), F.lit(0),
                          F.when(F.col("op") != "d", F.create_map(F.lit("id"), F.col("id").cast("string"),
                                                                  F.lit("sku_num"), F.col("new").cast("string"))),
                          F.when(F.col("old").isNotNull(), F.create_map(F.lit("sku_num"), F.col("old").cast("string"))))
    adds = {r.id: r.sku_num for r in cart_adds(env).collect()}
    assert adds == {"1": 2, "2": 2}
    rules = latest_rules(spark.createDataFrame([("cart_info", "dim_cart", "c", 1), ("cart_info", "dim_cart", "d", 2)],
                                               "source_table string, sink_table string, op string, ts_ms int"))
    dims, facts = route_by_rules(env, rules)
    assert dims.count() == 0 and facts.count() == 3          # deleted rule; the delete has no after image
    assert filter_cdc(env, table="other").count() == 0
