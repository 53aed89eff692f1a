"""Sources and sinks: JSON lines, weight files, tokenizer UDTF/CJK path, dimension router batch,
idempotent foreachBatch writers, dimension tables, Kafka option builders."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.tags import AGE_BRACKETS
from tidemart.functions.tokenize import register_split_words, tokenize, tokenize_cjk
from tidemart.operators.scoring import attach_weights
from tidemart.operators.wordlist import keep_flagged
from tidemart.schemas import ENVELOPE
from tidemart.sources.dims import (create_table_if_absent, drop_namespace, drop_table, list_tables, point_get, scan_limit,
                                   table_exists)
from tidemart.sources.files import read_json_lines, read_weight_file
from tidemart.sources.jdbc import lower_camel
from tidemart.streaming.jobs import route_cdc_batch
from tidemart.sources.dims import merge_cells
from tidemart.streaming.changelog import version_of
from tidemart.streaming.sinks import (compact_dim_table, day_bucket_writer, dim_batch_writer, kafka_sink_options, olap_batch_writer,
                                      read_dim_table, read_upserted, to_kafka_value, upsert_batch_writer)
from tidemart.streaming.sources import kafka_options


def test_json_lines_and_weights(spark, scratch):
    p = os.path.join(scratch, "recs.json")
    with open(p, "w") as fh:
        fh.write('{"a": 1, "b": "x"}\n{bad\n')
    df = read_json_lines(spark, p, "a long, b string, _bad string", corrupt_col="_bad")
    assert sorted(((r.a, r._bad) for r in df.collect()), key=str) == sorted([(1, None), (None, "{bad")], key=str)
    w = os.path.join(scratch, "w.txt")
    with open(w, "w", encoding="utf-8") as fh:
        fh.write(json.dumps({"alpha": {b: 0.5 for b in AGE_BRACKETS}}) + "\n")
        fh.write(json.dumps({"beta": {b: str(k / 8) for k, b in enumerate(AGE_BRACKETS[:5])}}) + "\n")
        fh.write(json.dumps({"alpha": {b: k / 4 for k, b in enumerate(AGE_BRACKETS)}}) + "\n")
    rows = spark.createDataFrame([("alpha",), ("beta",), ("other",), (None,)], "c string")
    got = {r.c: [r[f"x_w_{k}"] for k in range(6)] for r in
           attach_weights(rows, read_weight_file(spark, w, "x"), "x", "c").collect()}
    assert got["alpha"] == [0, 0.25, 0.5, 0.75, 1, 1.25]  # the last entry of a category counts
    assert got["beta"] == [0, 0.125, 0.25, 0.375, 0.5, 0] and got["other"] == got[None] == [0] * 6
    got = {r.c: r.x_w_1 for r in attach_weights(rows, read_weight_file(spark, w, "x"), "x", "c", fallback="beta").collect()}
    assert got == {"alpha": 0.25, "beta": 0.125, "other": 0.125, None: 0.125}
    many = spark.range(20_000).select(F.lit("x").alias("factor"), F.col("id").cast("string").alias("category"),
                                      F.array(*[F.col("id").cast("double")] * 6).alias("w"))
    got = attach_weights(spark.createDataFrame([("19999",)], "c string"), many, "x", "c").first()
    assert got.x_w_5 == 19999.0  # no limit on the size of a weight table
    empty = os.path.join(scratch, "empty.txt")
    open(empty, "w").close()
    nothing = read_weight_file(spark, empty, "x")  # making the plan reads nothing
    with pytest.raises(Exception, match="is empty"):
        attach_weights(rows, nothing, "x", "c").collect()


def test_watermarked_records_are_parsed_once(spark, scratch):
    from tidemart.streaming.sources import read_text_stream, read_with_watermark

    src = os.path.join(scratch, "topic")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as fh:
        fh.write('{"k":"a","ts_ms":5000,"ts":1}\n{"k":"b","ts":7000}\n{"k":"c"}\n{bad\n{"k":"d","ts":"8000"}\n')
    out = read_with_watermark(read_text_stream(spark, src), T.StructType([T.StructField("k", T.StringType())]))
    assert out.columns == ["value", "data", "et"] and out.schema["data"].dataType.names == ["k"]
    assert out._jdf.queryExecution().toString().lower().split("== physical plan ==")[0].count("try_parse_json") <= 2
    q = out.writeStream.format("memory").queryName("once").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r.k: r.ms for r in spark.table("once").selectExpr("data.k AS k", "unix_millis(et) AS ms").collect()}
    assert got == {"a": 5000, "b": 7000, "c": 0, None: 0, "d": 8000}


def test_tokenizers(spark):
    register_split_words(spark)
    spark.createDataFrame([("Hello, big World",)], "text string").createOrReplaceTempView("docs_t")
    words = [r.word for r in spark.sql("SELECT w.word FROM docs_t, LATERAL split_words(text) w").collect()]
    assert words == ["hello", "big", "world"]
    df = spark.createDataFrame([("小米手机和iPhone",)], "t string")
    assert df.select(tokenize_cjk("t", ["小米", "手机"]).alias("x")).first().x == ["小米", "手机", "和", "iphone"]
    text = "Für Café Привет 㐀𠀀 x_1"
    want = ["für", "café", "привет", "㐀", "𠀀", "x", "1"]
    assert spark.createDataFrame([(text,)], "t string").select(tokenize_cjk("t").alias("x")).first().x == want
    spark.createDataFrame([(text,)], "text string").createOrReplaceTempView("docs_t")
    assert [r.word for r in spark.sql("SELECT w.word FROM docs_t, LATERAL split_words(text) w").collect()] == want
    assert spark.createDataFrame([(text,)], "t string").select(tokenize(F.col("t")).alias("x")).first().x[:3] == want[:3]


def test_router_batch(spark, scratch):
    rules = os.path.join(scratch, "rules.json")
    with open(rules, "w") as fh:
        fh.write(json.dumps({"source_table": "user_info", "sink_table": "dim_user", "sink_family": "info",
                             "sink_columns": "id,name", "sink_row_key": "id", "op": "c", "ts_ms": 1}) + "\n")
    recs = [{"op": "c", "ts_ms": 5, "source": {"db": "s", "table": "user_info"}, "after": {"id": "1", "name": "a", "x": "9"}},
            {"op": "d", "ts_ms": 6, "source": {"db": "s", "table": "user_info"}, "before": {"id": "2"}},
            {"op": "c", "ts_ms": 7, "source": {"db": "s", "table": "order_info"}, "after": {"id": "3"}}]
    batch = spark.createDataFrame([(json.dumps(r),) for r in recs], "value string")
    route_cdc_batch(batch, rules, os.path.join(scratch, "dims"), os.path.join(scratch, "facts"), 0)
    dims = read_dim_table(spark, os.path.join(scratch, "dims", "dim_user"), "row_key string, id string, name string")
    facts = spark.read.json(os.path.join(scratch, "facts", "batch_id=0"))
    assert [tuple(r) for r in dims.collect()] == [("1", "1", "a")]  # keyed by sink_row_key, sink columns only
    later = [{"op": "u", "ts_ms": 8, "source": {"db": "s", "table": "user_info"}, "after": {"id": "1", "name": "b"}},
             {"op": "c", "ts_ms": 9, "source": {"db": "s", "table": "user_info"}, "after": {"id": "2", "name": "c"}}]
    for _ in range(2):  # a replayed batch gives the same table
        route_cdc_batch(spark.createDataFrame([(json.dumps(r),) for r in later], "value string"), rules,
                        os.path.join(scratch, "dims"), os.path.join(scratch, "facts"), 1)
        dims = read_dim_table(spark, os.path.join(scratch, "dims", "dim_user"), "row_key string, id string, name string")
        assert sorted(tuple(r) for r in dims.collect()) == [("1", "1", "b"), ("2", "2", "c")]
    assert facts.count() == 1
    with pytest.raises(Exception):   # no rules -> the batch fails and is retried later
        route_cdc_batch(batch, os.path.join(scratch, "missing.json"), os.path.join(scratch, "d2"),
                        os.path.join(scratch, "f2"), 1)


def test_idempotent_writers(spark, scratch):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k long, seq long, v string")
    olap = olap_batch_writer(os.path.join(scratch, "olap"))
    olap(df, 3)
    olap(df, 3)                       # replay of the same batch rewrites, not duplicates
    assert spark.read.json(os.path.join(scratch, "olap")).count() == 3
    up = upsert_batch_writer(os.path.join(scratch, "up"), ["k"], ["seq"])
    up(df, 0)
    up(spark.createDataFrame([(1, 0, "new"), (3, 1, "d")], "k long, seq long, v string"), 1)
    merged = read_upserted(spark, os.path.join(scratch, "up"), ["k"], ["seq"])
    assert sorted((r.k, r.v) for r in merged.collect()) == [(1, "new"), (2, "c"), (3, "d")]


DIM_SCHEMA = "k long, v string"


def dim_rows(spark, path):
    return sorted((r.k, r.v) for r in read_dim_table(spark, path, DIM_SCHEMA).collect())


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), "k long, seq long, op string, v string")


def test_dim_writer_merges_replays_and_empties(spark, scratch):
    path = os.path.join(scratch, "dim")
    write = dim_batch_writer(path, "k", ["seq"], ["v"])
    assert dim_rows(spark, path) == []
    write(changes(spark, *[(k, 1, "c", f"v{k}") for k in range(5)]), 0)
    write(changes(spark, (1, 2, "u", ""), (2, 2, "d", None)), 1)
    want = [(0, "v0"), (1, "v1"), (3, "v3"), (4, "v4")]
    assert dim_rows(spark, path) == want
    write(changes(spark, (1, 2, "u", ""), (2, 2, "d", None)), 1)
    assert dim_rows(spark, path) == want
    write(changes(spark, *[(k, 3, "d", None) for k in range(5)]), 2)
    assert dim_rows(spark, path) == []  # an empty version is a version
    write(changes(spark, (1, 4, "c", "back")), 3)
    assert dim_rows(spark, path) == [(1, "back")]


def test_a_dim_batch_writes_its_own_rows_only(spark, scratch):
    """A batch of 1,000 keys on a table of 20,000 writes 1,000 rows and reads none."""
    path = os.path.join(scratch, "dim")
    write = dim_batch_writer(path, "k", ["seq"], ["v"])
    write(spark.range(20_000).selectExpr("id AS k", "1L AS seq", "'c' AS op", "'a' AS v"), 0)
    compact_dim_table(spark, path, DIM_SCHEMA)
    write(spark.range(2_000).selectExpr("id % 1000 AS k", "id AS seq", "'u' AS op", "cast(id AS string) AS v"), 1)
    assert spark.read.parquet(os.path.join(path, "changes", "batch_id=1")).count() == 1000
    rows = dict(dim_rows(spark, path))
    assert len(rows) == 20_000 and rows[7] == "1007" and rows[1000] == "a"


def test_dim_compaction_replay_and_removal(spark, scratch):
    rng = random.Random(1)
    path, plain = os.path.join(scratch, "dim"), os.path.join(scratch, "plain")
    write, slow = dim_batch_writer(path, "k", ["seq"], ["v"], compact_every=3), dim_batch_writer(plain, "k", ["seq"], ["v"])
    batches = [changes(spark, *[(rng.randrange(8), rng.randrange(100), rng.choice("ccud"), rng.choice(["", None, f"{b}-{i}"]))
                                for i in range(6)]) for b in range(10)]
    so_far = None
    for b, rows in enumerate(batches):
        write(rows, b)
        slow(rows, b)
        so_far = merge_cells(rows, "k", ["seq"], ["v"], base=so_far)
    want = sorted((r.k, r.v) for r in so_far.collect())
    assert dim_rows(spark, path) == dim_rows(spark, plain) == want  # equals merging batch after batch
    at = version_of(spark, path)
    assert at.upto == 8 and at.batches == (9,) and at.superseded == ()
    assert sorted(os.listdir(os.path.join(path, "snapshot"))) == ["upto=5", "upto=8"]  # one snapshot back is kept for readers
    write(batches[7], 7)  # a replay of a batch that the snapshot covers changes nothing
    assert dim_rows(spark, path) == want
    os.unlink(os.path.join(path, "snapshot", "upto=8", "_SUCCESS"))  # a compaction that was stopped half-way
    assert version_of(spark, path).upto == 5 and dim_rows(spark, path) == want


def test_upserts_read_as_much_after_many_batches(spark, scratch):
    path = os.path.join(scratch, "up")
    write = upsert_batch_writer(path, ["k"], ["seq"], compact_every=4)
    for b in range(9):
        write(spark.createDataFrame([(k, b, f"{b}") for k in (b, b + 1, 100)], "k long, seq long, v string"), b)
    rows = read_upserted(spark, path, ["k"], ["seq"])
    assert {r.k: r.v for r in rows.collect()} == {0: "0", **{k: str(k) for k in range(1, 9)}, 9: "8", 100: "8"}
    at = version_of(spark, path)
    assert at.upto == 7 and at.batches == (8,)
    assert spark.read.parquet(os.path.join(path, "snapshot", "upto=7")).count() == 10


def test_a_corrupt_batch_is_not_skipped(spark, scratch):
    path = os.path.join(scratch, "dim")
    write = dim_batch_writer(path, "k", ["seq"], ["v"])
    write(changes(spark, (1, 1, "c", "a")), 0)
    for folder, _, files in os.walk(os.path.join(path, "changes")):
        for f in files:
            if f.endswith(".parquet"):
                with open(os.path.join(folder, f), "wb") as fh:
                    fh.write(b"not parquet")
                os.unlink(os.path.join(folder, f".{f}.crc"))
    write(changes(spark, (1, 2, "c", "b")), 1)
    with pytest.raises(Exception):
        dim_rows(spark, path)
    with pytest.raises(Exception):
        compact_dim_table(spark, path, DIM_SCHEMA)
    assert version_of(spark, path).upto == -1


def test_kafka_records(spark):
    df = spark.createDataFrame([(1, "a", None)], "k long, v string, w string")
    assert [r.asDict() for r in to_kafka_value(df).collect()] == [{"value": '{"k":1,"v":"a"}'}]
    assert [r.asDict() for r in to_kafka_value(df, ["k"]).collect()] == [{"key": '{"k":1}', "value": '{"k":1,"v":"a"}'}]


def test_day_bucket_writer(spark, scratch):
    write = day_bucket_writer(os.path.join(scratch, "days"), "t", tz="UTC")
    rows = spark.createDataFrame([(1, "1700000000"), (2, "1700000000000"), (3, "bad"), (4, None)], "k long, t string")
    for _ in range(2):
        write(rows, 5)
    got = {r.k: r.day for r in spark.read.json(os.path.join(scratch, "days")).select("k", F.col("day").cast("string")).collect()}
    assert got[1] == got[2] == "20231114" and got[3] == got[4] and not got[3].isdigit()


def test_keep_flagged_and_drop_namespace(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["c"]), (3, []), (4, None)], "id long, toks array<string>")
    words = spark.createDataFrame([("b",), ("",), (None,)], "word string")
    assert [r.id for r in keep_flagged(df, "id", "toks", words).collect()] == [1]
    spark.sql("CREATE NAMESPACE IF NOT EXISTS tm_probe_ns")
    create_table_if_absent(spark, "tm_probe_ns.t", "k bigint")
    drop_namespace(spark, "tm_probe_ns")
    assert "tm_probe_ns" not in [d.name for d in spark.catalog.listDatabases()]


def test_failed_offsets_fail_the_query_by_default():
    assert kafka_options("h:9092", "t")["failOnDataLoss"] == "true"
    assert kafka_options("h:9092", "t", extra={"failOnDataLoss": "false"})["failOnDataLoss"] == "false"


def test_dims_and_options(spark):
    df = spark.createDataFrame([(10, "x"), (9, "y"), (100, "z")], "k long, v string")
    assert [r.row_key for r in scan_limit(df, "k", 2).collect()] == ["10", "100"]
    assert point_get(df, "k", 9).first().v == "y"
    create_table_if_absent(spark, "tm_dim_test", "k bigint, v string")
    assert table_exists(spark, "tm_dim_test") and "tm_dim_test" in list_tables(spark, "default")
    drop_table(spark, "tm_dim_test")
    assert not table_exists(spark, "tm_dim_test")
    assert lower_camel("ORDER_DETAIL_ID") == "orderDetailId" and lower_camel("n_name") == "nName"
    o = kafka_options("h:9092", "topic_log")
    assert o["kafka.group.id"] == "topic_log1" and o["startingOffsets"] == "earliest"
    s = kafka_sink_options("h:9092", "t", exactly_once=True)
    assert s["kafka.acks"] == "all" and s["kafka.enable.idempotence"] == "true"
    assert ENVELOPE.fieldNames() == ["before", "after", "source", "op", "ts_ms"]


def test_cli_and_cluster_conf(spark, scratch):
    from tidemart.cli import main
    from tidemart.session import cluster_conf
    out = os.path.join(scratch, "pw")
    assert main(["run", "province_window", "--tables", "/root/testdata/sf0.001", "--out", out]) == 0
    assert spark.read.parquet(out).count() > 0
    c = cluster_conf(100 * (1 << 40), 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 102400 and c["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(cluster_conf(1 << 20, 16)["spark.sql.shuffle.partitions"]) == 48


def test_stream_start_uses_shared_checkpoint_dir(spark, scratch):
    from tidemart.session import checkpoint_dir
    from tidemart.streaming.sinks import olap_batch_writer, query_checkpoint, start
    src = os.path.join(scratch, "s")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as fh:
        fh.write('{"x": 1}\n{"x": 2}\n')
    stream = spark.readStream.schema("x long").json(src)
    name = "ckpt_probe_" + os.path.basename(scratch).replace("-", "_")   # a fresh query each run
    q = start(stream, olap_batch_writer(os.path.join(scratch, "o")), name=name)
    q.awaitTermination(120)
    ck = query_checkpoint(spark, name)
    assert ck.startswith(checkpoint_dir(spark)) and os.path.isdir(os.path.join(ck, "offsets"))
    assert spark.read.json(os.path.join(scratch, "o")).count() == 2
