"""Batch = stream: each keyed-state processor run as a file stream over several micro-batches
gives the same multiset as the batch operator; window results respect the watermark."""

import datetime as dt
import json
import os
from collections import Counter

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.operators.stateful import new_visitor_fix, retract_dedupe, visit_flags
from tidemart.streaming.jobs import (exact_dedupe_stream, first_per_key_stream, province_window_stream, retract_stream, with_state)
from tidemart.streaming.processors import BloomDedupe, FirstPerDay, NewVisitorFix, RunningProfile, VisitFlags, bloom_size

SCHEMA = T.StructType([T.StructField("seq", T.LongType()), T.StructField("k", T.LongType()),
                       T.StructField("d", T.DateType()), T.StructField("is_new", T.StringType()),
                       T.StructField("amt", T.LongType()), T.StructField("lp", T.StringType())])


def rows():
    out = []
    for i in range(60):
        k = i % 4
        out.append({"seq": i, "k": k, "d": str(dt.date(2024, 1, 1) + dt.timedelta(days=i // 7)),
                    "is_new": "1" if i % 3 == 0 else "0", "amt": (i * 7) % 23 - 5, "lp": None if i % 5 == 0 else "home"})
    return out


def write_files(folder, recs, n_files=4):
    os.makedirs(folder, exist_ok=True)
    for f in range(n_files):
        with open(os.path.join(folder, f"part-{f}.json"), "w") as fh:
            for r in recs[f::n_files]:
                fh.write(json.dumps(r) + "\n")


def run_stream(spark, df, scratch, name):
    q = (df.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ckpt_" + name)).trigger(availableNow=True).start())
    q.awaitTermination(300)
    return spark.table(name)


@pytest.fixture()
def stream_in(spark, scratch):
    src = os.path.join(scratch, "in")
    write_files(src, rows())
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(src)


def test_new_visitor_fix_batch_equals_stream(spark, scratch, stream_in):
    batch = spark.read.schema(SCHEMA).json(os.path.join(scratch, "in"))
    want = Counter((r.seq, r.is_new) for r in new_visitor_fix(batch, "k", ["seq"], "d").collect())
    out = with_state(stream_in, "k", NewVisitorFix(["seq"], "d"), SCHEMA)
    got = Counter((r.seq, r.is_new) for r in run_stream(spark, out, scratch, "sta1").collect())
    assert got == want


def test_visit_flags_batch_equals_stream(spark, scratch, stream_in):
    batch = spark.read.schema(SCHEMA).json(os.path.join(scratch, "in"))
    want = Counter((r.seq, r.uv_ct, r.sv_ct) for r in visit_flags(batch, "k", ["seq"], "d", "lp").collect())
    schema = T.StructType(SCHEMA.fields + [T.StructField(n, T.LongType()) for n in ("uv_ct", "sv_ct", "pv_ct")])
    out = with_state(stream_in, "k", VisitFlags(["seq"], "d", "lp"), schema)
    got = Counter((r.seq, r.uv_ct, r.sv_ct) for r in run_stream(spark, out, scratch, "sta2").collect())
    assert got == want


def test_retract_batch_equals_stream(spark, scratch, stream_in):
    batch = spark.read.schema(SCHEMA).json(os.path.join(scratch, "in"))
    want = Counter((r.seq, r.amt, r.sign) for r in retract_dedupe(batch, "k", ["seq"], ["amt"]).collect())
    out = retract_stream(stream_in, "k", ["seq"], ["amt"])
    got = Counter((r.seq, r.amt, r.sign) for r in run_stream(spark, out, scratch, "sta4").collect())
    assert got == want


TYPED = T.StructType([T.StructField("seq", T.LongType()), T.StructField("k", T.LongType()),
                      T.StructField("amt", T.DecimalType(16, 2)), T.StructField("t", T.TimestampType()),
                      T.StructField("d", T.DateType()), T.StructField("note", T.StringType())])


def typed_rows(folder):
    """Ids spread over four micro-batches in arrival order, with exact repeats, null ids and null amounts."""
    os.makedirs(folder)
    recs = []
    for i in range(40):
        seq = i - i % 5 if i % 5 == 4 else i  # every fifth record repeats the one four before it
        recs.append({"seq": seq, "k": None if seq % 7 == 3 else seq % 3, "amt": None if seq % 6 == 5 else f"{seq}.25",
                     "t": f"2024-01-01T00:00:{seq:02d}.123456Z", "d": None if seq % 4 == 1 else f"2024-02-{seq % 28 + 1:02d}",
                     "note": None if seq % 2 else f"n{seq}"})
    recs.sort(key=lambda r: r["seq"])
    for f in range(4):
        with open(os.path.join(folder, f"part-{f}.json"), "w") as fh:
            for r in recs[10 * f:10 * f + 10]:
                fh.write(json.dumps(r) + "\n")
        os.utime(os.path.join(folder, f"part-{f}.json"), (1_700_000_000 + f, 1_700_000_000 + f))


def test_retract_stream_keeps_types(spark, scratch):
    """STA4 on decimal, timestamp, date and null columns: batch and stream agree, memory crosses micro-batches."""
    src = os.path.join(scratch, "typed")
    typed_rows(src)
    batch = spark.read.schema(TYPED).json(src)
    cols = ["seq", "k", "amt", "t", "d", "note", "sign"]
    want = Counter(tuple(r[c] for c in cols) for r in retract_dedupe(batch, "k", ["seq"], ["amt"]).collect())
    stream = spark.readStream.schema(TYPED).option("maxFilesPerTrigger", 1).json(src)
    out = run_stream(spark, retract_stream(stream, "k", ["seq"], ["amt"]), scratch, "sta4_typed")
    assert Counter(tuple(r[c] for c in cols) for r in out.collect()) == want
    assert sum(want.values()) > 70


def test_exact_and_first_dedupe_streams(spark, scratch):
    src = os.path.join(scratch, "typed")
    typed_rows(src)
    batch = spark.read.schema(TYPED).json(src)
    stream = spark.readStream.schema(TYPED).option("maxFilesPerTrigger", 1).json(src)
    cols = ["seq", "k", "amt", "d", "note"]
    out = run_stream(spark, exact_dedupe_stream(stream, cols, "t", "1 hour"), scratch, "sta7")
    want = sorted({str([r[c] for c in cols]) for r in batch.collect()})
    assert sorted(str([r[c] for c in cols]) for r in out.collect()) == want
    first = run_stream(spark, first_per_key_stream(stream, "k", ["seq"]), scratch, "sta6")
    got = {r.k: r.seq for r in first.collect()}
    assert got == {k: min(r.seq for r in batch.collect() if r.k == k) for k in (None, 0, 1, 2)} and first.count() == 4


def test_processors_take_rows_without_a_date(spark):
    """A record without a date passes unchanged and leaves no memory; nulls sort first."""
    class Value:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, v):
            self.value = v

    p = NewVisitorFix(["seq"], "d")
    p.state = Value()
    day = dt.date(2024, 1, 1)
    rows_ = [Row(seq=2, d=day, is_new="1"), Row(seq=None, d=None, is_new="1"), Row(seq=3, d=day + dt.timedelta(days=1), is_new="1")]
    assert [r.is_new for r in p.handleInputRows(("k",), iter(rows_), None)] == ["1", "1", "0"]


def test_first_per_day_and_profile_stream(spark, scratch, stream_in):
    out = with_state(stream_in, ["k", "d"], FirstPerDay(["seq"]), SCHEMA)
    got = run_stream(spark, out, scratch, "sta3").collect()
    assert len(got) == len({(r["k"], r["d"]) for r in rows()})
    schema = T.StructType(SCHEMA.fields + [T.StructField("page_count", T.LongType()), T.StructField("lp_set", T.StringType())])
    prof = run_stream(spark, with_state(stream_in, "k", RunningProfile(["seq"], ["lp"]), schema), scratch, "agg7").collect()
    last = max((r for r in prof if r.k == 1), key=lambda r: r.seq)
    assert last.page_count == sum(1 for r in rows() if r["k"] == 1) and last.lp_set == "home"


def test_bloom_dedupe_stream(spark, scratch, stream_in):
    m, k = bloom_size(1_000_000, 0.01)
    assert (m, k) == (9585059, 7)
    out = with_state(stream_in.withColumn("b", F.col("seq") % 5), "k", BloomDedupe(["seq"], "k", "b", n=10_000, p=0.001),
                     T.StructType(SCHEMA.fields + [T.StructField("b", T.LongType())]))
    got = run_stream(spark, out, scratch, "sta8").collect()
    assert sorted((r.k, r.b) for r in got) == sorted({(r["k"], r["seq"] % 5) for r in rows()})


def test_province_window_stream_and_watermark(spark, scratch):
    src = os.path.join(scratch, "details")
    base = 1_700_000_000_000
    recs = [{"id": f"d{i % 7}", "order_id": i % 5, "province_id": i % 2, "split_total_amount": 10 + i, "ts_ms": base + i * 1000}
            for i in range(30)]
    recs.append({"id": "late", "order_id": 99, "province_id": 0, "split_total_amount": 1000, "ts_ms": base - 60_000})
    recs.append({"id": "sentinel", "order_id": 98, "province_id": 1, "split_total_amount": 0, "ts_ms": base + 3_600_000})
    os.makedirs(src)
    for j, chunk in enumerate([recs[:30], recs[30:]]):
        path = os.path.join(src, f"p{j}.json")
        with open(path, "w") as fh:
            fh.write("\n".join(json.dumps(r) for r in chunk) + "\n")
        os.utime(path, (1_000_000 + j * 100, 1_000_000 + j * 100))  # file streams read in modification order
    schema = "id string, order_id long, province_id long, split_total_amount long, ts_ms long"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(src)
    provinces = spark.createDataFrame([(0, "p0"), (1, "p1")], "id long, name string")
    out = run_stream(spark, province_window_stream(stream, provinces, "10 seconds", "5 seconds", "UTC"), scratch, "agg4")
    got = {(r.stt, r.province_id): (r.order_amount, r.order_count) for r in out.collect()}
    # batch form of the same chain on the same rows (an order counts where a line of it is left); the sentinel's own
    # window is still open
    batch = spark.read.schema(schema).json(src)
    signed = retract_dedupe(batch, "id", ["ts_ms"], ["split_total_amount"], net=True)
    w = signed.withColumn("et", F.timestamp_millis("ts_ms")).groupBy(F.window("et", "10 seconds").alias("w"), "province_id")
    want = {(r.stt, r.province_id): (r.a, r.c) for r in w.agg(F.sum("split_total_amount").alias("a"),
                                                              F.count_distinct("order_id").alias("c"))
            .select(F.date_format(F.col("w.start"), "yyyy-MM-dd HH:mm:ss").alias("stt"), "province_id", "a", "c").collect()
            if r.stt != "2023-11-14 23:13:20"}
    assert got == want


def test_late_rows_dropped_by_watermark(spark, scratch):
    """Rows within the delay are kept; each window is emitted exactly once (append mode).

    Spark does not promise to drop a row older than the watermark: a row whose
    window was never emitted is still counted once, late (the source system
    drops it). Windows already emitted are never emitted again.
    """
    from tidemart.operators.windows import window_aggregate, with_event_time
    src = os.path.join(scratch, "clicks")
    os.makedirs(src)
    base = 1_700_000_000_000
    batches = [[base + i * 1000 for i in range(20)], [base - 60_000, base + 16_000], [base + 600_000]]
    for j, ts in enumerate(batches):
        path = os.path.join(src, f"b{j}.json")
        with open(path, "w") as fh:
            fh.write("\n".join(json.dumps({"user": f"u{t % 3}", "ts": t}) for t in ts) + "\n")
        os.utime(path, (1_000_000 + j * 100, 1_000_000 + j * 100))
    stream = spark.readStream.schema("user string, ts long").option("maxFilesPerTrigger", 1).json(src)
    agg = window_aggregate(with_event_time(stream, "ts", "5 seconds"), "et", "10 seconds", [],
                           [F.count(F.lit(1)).alias("n")], tz="UTC")
    out = run_stream(spark, agg, scratch, "late").collect()
    got = {r.stt: r.n for r in out}
    assert len(got) == len(out)                      # no window emitted twice
    assert got["2023-11-14 22:13:20"] == 10
    assert got["2023-11-14 22:13:30"] == 11          # 10 on time + 1 within the delay
    assert "2023-11-14 22:23:20" not in got          # still open at the end of the stream


def test_restart_from_checkpoint_keeps_state(spark, scratch):
    """Stop after the first files, restart on the same checkpoint with more files: the keyed state
    (previous record per id) carries over and the file sink holds each output row exactly once."""
    src, out, ck = (os.path.join(scratch, p) for p in ("in", "out", "ck"))
    os.makedirs(src)
    recs = [{"id": f"k{i % 3}", "seq": i, "amt": i + 1} for i in range(12)]
    schema = "id string, seq long, amt long"

    def add(j, chunk):
        path = os.path.join(src, f"f{j}.json")
        with open(path, "w") as fh:
            fh.write("\n".join(json.dumps(r) for r in chunk) + "\n")
        os.utime(path, (1_000_000 + j * 100,) * 2)

    def run():
        s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(src)
        q = (retract_stream(s, "id", ["seq"], ["amt"]).writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination(300)

    add(0, recs[:6])
    run()
    add(1, recs[6:])
    run()                                   # a new query on the same checkpoint
    got = Counter((r.id, r.seq, r.amt, r.sign) for r in spark.read.parquet(out).collect())
    batch = spark.createDataFrame(recs, schema)
    want = Counter((r.id, r.seq, r.amt, r.sign) for r in retract_dedupe(batch, "id", ["seq"], ["amt"]).collect())
    assert got == want


def test_order_detail_stream_join(spark, scratch):
    """Detail ⋈ header, ⟕ activity on watermarked streams: matched within the bound, unmatched
    details emitted once the watermark passes (the global watermark is the minimum over the
    inputs, so every source gets a far-future sentinel row)."""
    from tidemart.streaming.jobs import order_detail_wide_stream
    base = 1_700_000_000_000
    folders = {}
    data = {
        "details": [{"id": f"d{i}", "order_id": i % 3, "ts": base + i * 1000} for i in range(6)]
        + [{"id": "late_sentinel", "order_id": 99, "ts": base + 600_000}],
        "headers": [{"id": i, "ts": base + i * 1000} for i in range(3)] + [{"id": 99, "ts": base + 600_000}],
        "acts": [{"order_detail_id": "d1", "ts": base + 1500}, {"order_detail_id": "x", "ts": base + 600_000}],
        "cpns": [{"order_detail_id": "d2", "ts": base + 2500}, {"order_detail_id": "d4", "ts": base + 90_000},
                 {"order_detail_id": "x", "ts": base + 600_000}],
    }
    for name, rows_ in data.items():
        folders[name] = os.path.join(scratch, name)
        os.makedirs(folders[name])
        with open(os.path.join(folders[name], "p.json"), "w") as fh:
            fh.write("\n".join(json.dumps(r) for r in rows_) + "\n")

    def stream(name, schema):
        return (spark.readStream.schema(schema).json(folders[name])
                .withColumn("et", F.timestamp_millis("ts")).drop("ts"))

    joined = order_detail_wide_stream(stream("details", "id string, order_id long, ts long"),
                                      stream("headers", "id long, ts long"),
                                      stream("acts", "order_detail_id string, ts long"),
                                      stream("cpns", "order_detail_id string, ts long"),
                                      bound="10 seconds", delay="5 seconds")
    out = joined.select(F.col("d.id").alias("id"), F.col("a.order_detail_id").alias("act"),
                        F.col("c.order_detail_id").alias("cpn"))
    got = {r.id: (r.act, r.cpn) for r in run_stream(spark, out, scratch, "odw").collect()}
    assert got["d1"] == ("d1", None) and got["d2"] == (None, "d2")
    assert got["d4"] == (None, None)        # coupon 86 s later: outside the 10 s bound
    assert got["d0"] == (None, None) and len([k for k in got if k.startswith("d")]) == 6


def test_log_cleaning_streams(spark, scratch):
    """DWD log job on a file stream: dirty records split off, is_new repaired per device, pages routed."""
    from tidemart.streaming.jobs import log_cleaning_streams
    src = os.path.join(scratch, "logs")
    os.makedirs(src)
    base = 1_704_067_200_000  # 2024-01-01 00:00 UTC
    lines = [json.dumps({"common": {"mid": "m1", "is_new": "1"}, "page": {"page_id": "home"}, "ts": base}),
             json.dumps({"common": {"mid": "m1", "is_new": "1"}, "ts": base + 86_400_000}),
             json.dumps({"common": {"mid": "m2", "is_new": "0"}, "page": {"page_id": "x"}, "ts": base}),
             "{broken", "[1, 2]"]
    with open(os.path.join(src, "a.json"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    bad, fixed, pages = log_cleaning_streams(spark.readStream.format("text").load(src), tz="UTC")
    assert sorted(r.value for r in run_stream(spark, bad, scratch, "dirty").collect()) == ["[1, 2]", "{broken"]
    got = {(r.mid, r.ts): r.is_new for r in run_stream(spark, fixed, scratch, "fixed").collect()}
    assert got == {("m1", base): "1", ("m1", base + 86_400_000): "0", ("m2", base): "0"}
    assert sorted(r.mid for r in run_stream(spark, pages, scratch, "pages").collect()) == ["m1", "m2"]


def _write_ordered(folder, chunks):
    os.makedirs(folder)
    for j, chunk in enumerate(chunks):
        path = os.path.join(folder, f"p{j}.json")
        with open(path, "w") as fh:
            fh.write("\n".join(json.dumps(r) for r in chunk) + "\n")
        os.utime(path, (1_000_000 + j * 100,) * 2)


def test_page_view_and_cart_windows_stream_equal_batch(spark, scratch):
    from tidemart.operators.stateful import first_per_key
    from tidemart.operators.windows import window_aggregate
    from tidemart.streaming.jobs import cart_uu_window_stream, page_view_window_stream
    base = 1_704_067_200_000
    pages = [{"mid": f"m{i % 4}", "ts": base + i * 3000 + (i % 4) * 86_400_000 * (i // 20),
              "last_page_id": None if i % 5 == 0 else "home", "during_time": i * 10, "ar": str(i % 2),
              "ch": "web", "vc": "v1", "is_new": "0"} for i in range(40)]
    pages.sort(key=lambda r: r["ts"])
    pages.append({"mid": "sentinel", "ts": base + 10 * 86_400_000, "last_page_id": "x", "during_time": 0,
                  "ar": "z", "ch": "z", "vc": "z", "is_new": "0"})
    src = os.path.join(scratch, "pages")
    _write_ordered(src, [pages[:15], pages[15:30], pages[30:]])
    schema = "mid string, ts long, last_page_id string, during_time long, ar string, ch string, vc string, is_new string"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(src) \
        .withColumn("visit_date", F.to_date(F.timestamp_millis("ts")))
    got = {(r.stt, r.ar): (r.dur_sum, r.pv_ct, r.uv_ct, r.sv_ct)
           for r in run_stream(spark, page_view_window_stream(stream, tz="UTC"), scratch, "pvw").collect()}
    batch = spark.read.schema(schema).json(src).withColumn("visit_date", F.to_date(F.timestamp_millis("ts")))
    flags = visit_flags(batch, "mid", ["ts"], "visit_date", "last_page_id").withColumn("et", F.timestamp_millis("ts"))
    want = {(r.stt, r.ar): (r.d, r.p, r.u, r.s) for r in window_aggregate(
        flags, "et", "10 seconds", ["ar", "ch", "vc", "is_new"],
        [F.sum("during_time").alias("d"), F.sum("pv_ct").alias("p"), F.sum("uv_ct").alias("u"),
         F.sum("sv_ct").alias("s")], tz="UTC").collect() if r.ar != "z"}
    assert got == want

    adds = [{"user_id": i % 3, "ts": base + i * 4000} for i in range(30)] + [{"user_id": 9, "ts": base + 86_400_000}]
    src2 = os.path.join(scratch, "adds")
    _write_ordered(src2, [adds[:10], adds[10:20], adds[20:]])
    s2 = spark.readStream.schema("user_id long, ts long").option("maxFilesPerTrigger", 1).json(src2) \
        .withColumn("add_date", F.to_date(F.timestamp_millis("ts")))
    got2 = {r.stt: r.cart_add_uu_ct for r in run_stream(spark, cart_uu_window_stream(s2, tz="UTC"), scratch, "cuu").collect()}
    b2 = spark.read.schema("user_id long, ts long").json(src2).withColumn("add_date", F.to_date(F.timestamp_millis("ts")))
    f2 = first_per_key(b2, ["user_id", "add_date"], ["ts"]).withColumn("et", F.timestamp_millis("ts"))
    want2 = {r.stt: r.n for r in window_aggregate(f2, "et", "10 seconds", [], [F.count(F.lit(1)).alias("n")], tz="UTC")
             .collect() if not r.stt.startswith("2024-01-02")}
    assert got2 == want2


def test_sku_and_keyword_windows_stream(spark, scratch):
    from tidemart.operators.windows import window_aggregate
    from tidemart.streaming.jobs import keyword_window_stream, sku_window_stream
    base = 1_704_067_200_000
    det = [{"id": f"d{i % 5}", "sku_id": i % 3, "ts_ms": base + i * 1000, "split_original_amount": 10 * i,
            "split_activity_amount": i, "split_coupon_amount": 0, "split_total_amount": 9 * i} for i in range(24)]
    det.append({"id": "s", "sku_id": 0, "ts_ms": base + 3_600_000, "split_original_amount": 0,
                "split_activity_amount": 0, "split_coupon_amount": 0, "split_total_amount": 0})
    src = os.path.join(scratch, "det")
    _write_ordered(src, [det[:8], det[8:16], det[16:]])
    schema = ("id string, sku_id long, ts_ms long, split_original_amount long, split_activity_amount long, "
              "split_coupon_amount long, split_total_amount long")
    skus = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "id long, sku_name string")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(src)
    got = {(r.stt, r.sku_id): (r.split_total_amount, r.sku_name) for r in run_stream(
        spark, sku_window_stream(stream, skus, ttl_ms=None, tz="UTC"), scratch, "skuw").collect()}
    batch = retract_dedupe(spark.read.schema(schema).json(src), "id", ["ts_ms"], ["split_total_amount"])
    want = {(r.stt, r.sku_id): (r.t, "abc"[r.sku_id]) for r in window_aggregate(
        batch.withColumn("et", F.timestamp_millis("ts_ms")), "et", "5 seconds", ["sku_id"],
        [F.sum("split_total_amount").alias("t")], tz="UTC").collect() if not r.stt.startswith("2024-01-01 01:")}
    assert got == want

    logs = [json.dumps({"page": {"last_page_id": "search", "item": w, "item_type": "keyword"}, "ts": base + i * 2000})
            for i, w in enumerate(["小米手机", "联想电脑", "小米手机", "衬衫"])]
    logs.append(json.dumps({"page": {"last_page_id": "search", "item": "x", "item_type": "keyword"}, "ts": base + 600_000}))
    src3 = os.path.join(scratch, "logs")
    os.makedirs(src3)
    with open(os.path.join(src3, "a.json"), "w") as fh:
        fh.write("\n".join(logs) + "\n")
    from tidemart.schemas import PAGE_LOG
    pages = spark.readStream.schema(PAGE_LOG).json(src3)
    got3 = {(r.stt, r.keyword): r.keyword_count for r in run_stream(
        spark, keyword_window_stream(pages, ["小米", "手机", "联想", "电脑", "衬衫"], tz="UTC"), scratch, "kww").collect()}
    assert got3 == {("2024-01-01 00:00:00", "小米"): 2, ("2024-01-01 00:00:00", "手机"): 2,
                    ("2024-01-01 00:00:00", "联想"): 1, ("2024-01-01 00:00:00", "电脑"): 1,
                    ("2024-01-01 00:00:00", "衬衫"): 1}


def test_age_inference_stream_equals_batch(spark, scratch):
    from tidemart.functions.tags import AGE_BRACKETS
    from tidemart.operators.joins import interval_join
    from tidemart.operators.scoring import FACTOR_ORDER, infer_age
    from tidemart.streaming.jobs import age_inference_stream
    base, day = 1_704_067_200_000, 86_400_000
    wcols = lambda fs: {f"{f}_w_{i}": 0.1 * ((i + len(f)) % 9 + 1) for f in fs for i in range(len(AGE_BRACKETS))}
    orders = [{"user_id": u, "ts": base + k * day, **wcols(["category", "brand", "time", "price"])}
              for u in range(3) for k in range(3)]
    for r in orders:
        r["category_w_5"] = 10.0 if r["user_id"] == 2 else 0.1      # user 2 leans to the last bracket
    kws = [{"user_id": u, "ts": base + k * day + 5, **wcols(["keyword", "device"])} for u in range(3) for k in range(2)]
    kws[0]["keyword_w_0"] = 5.0
    sentinel = {"user_id": 99, "ts": base + 200 * day}
    src_o, src_k = os.path.join(scratch, "o"), os.path.join(scratch, "k")
    _write_ordered(src_o, [orders, [{**sentinel, **wcols(["category", "brand", "time", "price"])}]])
    _write_ordered(src_k, [kws, [{**sentinel, **wcols(["keyword", "device"])}]])
    so = ", ".join(["user_id long", "ts long"] + [f"{f}_w_{i} double" for f in ("category", "brand", "time", "price") for i in range(6)])
    sk = ", ".join(["user_id long", "ts long"] + [f"{f}_w_{i} double" for f in ("keyword", "device") for i in range(6)])
    out = age_inference_stream(spark.readStream.schema(so).json(src_o), spark.readStream.schema(sk).json(src_k),
                               bound_ms=2 * day)
    got = Counter((r.user_id, r.l_t, r.r_t, r.inferred_age) for r in run_stream(spark, out, scratch, "age").collect())
    lo = spark.read.schema(so).json(src_o).withColumnRenamed("user_id", "l_user").withColumnRenamed("ts", "l_t")
    rk = spark.read.schema(sk).json(src_k).withColumnRenamed("user_id", "r_user").withColumnRenamed("ts", "r_t")
    b = interval_join(lo, rk, "l_user", "r_user", "l_t", "r_t", -2 * day, 2 * day)
    want = Counter((r.l_user, r.l_t, r.r_t, r.a) for r in b.select(
        "l_user", "l_t", "r_t", infer_age({f: f"{f}_w" for f in FACTOR_ORDER}).alias("a")).collect())
    assert got == want and len(set(r[3] for r in got)) >= 2
