"""State that grows entry by entry, and timers: profiles, exact pairs, live rules, processing-time windows, retractions."""

import json
import os
import random
import time
from collections import Counter

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.test_streaming import _write_ordered, run_stream
from tidemart.operators.scan import running_profile_records
from tidemart.operators.stateful import composite_dedupe, retract_dedupe
from tidemart.schemas import DIM_RULE, ENVELOPE
from tidemart.streaming.jobs import (last_per_processing_window, pair_dedupe_stream, province_window_stream,
                                     route_cdc_stream, routed_batch_writer, running_profile_stream)
from tidemart.streaming.processors import HoldForRules, LastPerProcessingWindow, PairDedupe, RunningProfile
from tidemart.streaming.sinks import read_dim_table

EVENTS = "k string, seq long, os string, word string"


class Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, v):
        self.value = v

    def clear(self):
        self.value = None


class Entries:
    def __init__(self):
        self.data, self.writes = {}, 0

    def containsKey(self, k):
        return k in self.data

    def updateValue(self, k, v):
        self.data[k] = v
        self.writes += 1

    def keys(self):
        return iter(list(self.data))

    def iterator(self):
        return iter(list(self.data.items()))


class Rows:
    def __init__(self):
        self.rows = []

    def exists(self):
        return bool(self.rows)

    def appendValue(self, v):
        self.rows.append(v)

    def get(self):
        return iter(list(self.rows))

    def clear(self):
        self.rows = []


class Clock:
    """Handle and timer values of a processor under test."""

    def __init__(self, now=0):
        self.now, self.timers = now, []

    def getValueState(self, *a):
        return Value()

    def getMapState(self, *a):
        return Entries()

    def getListState(self, *a):
        return Rows()

    def registerTimer(self, at):
        self.timers.append(at)

    def getCurrentProcessingTimeInMs(self):
        return self.now

    def getExpiryTimeInMs(self):
        return self.now


def started(processor, now=0):
    clock = Clock(now)
    processor.init(clock)
    return processor, clock


def hot_events(n=160, seed=1):
    rng = random.Random(seed)
    return [{"k": rng.choice(["-1", "-1", "a", "b", None]), "seq": i, "os": rng.choice(["ios", "and", None]),
             "word": rng.choice([None, f"w{rng.randrange(12)}"])} for i in range(n)]


def chunks_of(recs, n=4):
    return [recs[i * len(recs) // n:(i + 1) * len(recs) // n] for i in range(n)]


def test_running_profile_stream_equals_batch(spark, scratch):
    src = os.path.join(scratch, "in")
    _write_ordered(src, chunks_of(hot_events()))
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).json(src)
    got = run_stream(spark, running_profile_stream(stream, "k", ["seq"], ["os", "word"]), scratch, "profile_records")
    want = running_profile_records(spark.read.schema(EVENTS).json(src), "k", ["seq"], ["os", "word"], ranges=6)
    assert Counter(map(tuple, got.select(*want.columns).collect())) == Counter(map(tuple, want.collect()))


def test_profile_state_grows_with_new_values_only():
    p, _ = started(RunningProfile(["seq"], ["word"]))
    for batch in range(20):
        list(p.handleInputRows(("k",), iter([Row(seq=batch * 10 + i, word=f"w{i % 5}") for i in range(10)]), None))
    assert p.values.writes == 5 and p.count.get() == (200,)
    out = list(p.handleInputRows(("k",), iter([Row(seq=999, word="new")]), None))
    assert p.values.writes == 6 and out[0].word_set == "new,w0,w1,w2,w3,w4" and out[0].page_count == 201


def test_pair_dedupe_stream_is_exact(spark, scratch):
    src = os.path.join(scratch, "in")
    _write_ordered(src, chunks_of(hot_events(seed=2)))
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).json(src)
    got = run_stream(spark, pair_dedupe_stream(stream, "k", "word", ["seq"], slots=5), scratch, "pairs")
    want = composite_dedupe(spark.read.schema(EVENTS).json(src), "k", "word", ["seq"])
    assert Counter(map(tuple, got.select(*want.columns).collect())) == Counter(map(tuple, want.collect()))


def test_pair_dedupe_tells_nulls_and_borders_apart():
    p, _ = started(PairDedupe(["seq"], "a", "b"))
    rows = [Row(seq=i, a=a, b=b) for i, (a, b) in enumerate([(None, "x"), ("", "x"), ("x", None), ("a_b", "c"), ("a", "b_c"), (None, "x")])]
    assert [r.seq for r in p.handleInputRows((0,), iter(rows), None)] == [0, 1, 2, 3, 4]


def test_pair_state_expires(spark, scratch):
    """With a TTL the same pair comes out again once its entry has expired."""
    src = os.path.join(scratch, "in")
    _write_ordered(src, [[{"k": "a", "seq": 1, "word": "x"}]])
    stream = spark.readStream.schema(EVENTS).json(src)
    q = (pair_dedupe_stream(stream, "k", "word", ["seq"], ttl_ms=1500, slots=2).writeStream.format("memory").queryName("pair_ttl")
         .option("checkpointLocation", os.path.join(scratch, "ckpt")).trigger(processingTime="200 milliseconds").start())
    try:
        wait_for(lambda: spark.table("pair_ttl").count() == 1)
        time.sleep(2.5)
        with open(os.path.join(src, "again.json"), "w") as f:
            f.write(json.dumps({"k": "a", "seq": 2, "word": "x"}) + "\n" + json.dumps({"k": "a", "seq": 3, "word": "x"}) + "\n")
        wait_for(lambda: spark.table("pair_ttl").count() >= 2)
        time.sleep(1)
        assert sorted(r.seq for r in spark.table("pair_ttl").collect()) == [1, 2]
    finally:
        q.stop()


def wait_for(done, seconds=90):
    end = time.time() + seconds
    while not done():
        assert time.time() < end, "the stream did not get there"
        time.sleep(0.3)


# ---- live rules -----------------------------------------------------------------------
def rule(pos, table, sink="dim", op="c", columns="id,name"):
    return Row(is_rule=True, pos=pos, op=op, source_table=table, value=None, sink_table=sink, sink_family="info",
               sink_columns=columns, sink_row_key="id")


def feed(pos, table):
    return Row(is_rule=False, pos=pos, op="c", source_table=table, value=f"v{pos}", sink_table=None, sink_family=None,
               sink_columns=None, sink_row_key=None)


def test_rows_wait_for_rules_and_leave_in_order():
    p, clock = started(HoldForRules(wait_ms=5000), now=100)
    assert list(p.handleInputRows((0,), iter([feed(2, "user"), feed(1, "order")]), clock)) == []
    assert list(p.handleInputRows((0,), iter([feed(3, "user")]), clock)) == []
    assert clock.timers == [5100]  # one timer for all that wait
    clock.now = 5100
    assert list(p.handleExpiredTimer((0,), clock, clock)) == [] and clock.timers == [5100, 10_100]
    assert list(p.handleInputRows((0,), iter([rule(4, "user")]), clock)) == []
    clock.now = 10_100
    out = [(r.pos, r.sink_table) for r in p.handleExpiredTimer((0,), clock, clock)]
    assert out == [(1, None), (2, "dim"), (3, "dim")] and not p.held.exists()
    assert list(p.handleExpiredTimer((0,), clock, clock)) == [] and len(clock.timers) == 2


def test_a_later_row_lets_the_waiting_out_first():
    p, clock = started(HoldForRules())
    list(p.handleInputRows((0,), iter([feed(1, "user")]), clock))
    out = list(p.handleInputRows((0,), iter([feed(3, "user"), rule(2, "user")]), clock))
    assert [(r.pos, r.sink_table) for r in out] == [(1, "dim"), (3, "dim")]


def test_a_rule_change_acts_from_its_position():
    p, clock = started(HoldForRules())
    rows = [rule(1, "user", "old"), feed(2, "user"), rule(3, "user", "new"), feed(3, "user"), rule(5, "user", op="d"),
            rule(5, "other"), feed(4, "user"), feed(6, "user")]
    want = [(2, "old"), (3, "new"), (4, "new"), (6, None)]
    random.Random(1).shuffle(rows)
    assert [(r.pos, r.sink_table) for r in p.handleInputRows((0,), iter(rows), clock)] == want
    list(p.handleInputRows((0,), iter([rule(2, "user", "stale")]), clock))  # older than the change that is kept
    assert [r.sink_table for r in p.handleInputRows((0,), iter([feed(9, "user")]), clock)] == [None]
    again, clock = started(HoldForRules())
    assert [(r.pos, r.sink_table) for r in again.handleInputRows((0,), iter(rows), clock)] == want


def envelope(i, table, ts, op="c", name="n"):
    return {"before": None, "after": {"id": str(i), "name": name, "secret": "s"}, "source": {"table": table}, "op": op, "ts_ms": ts}


def test_route_stream_releases_rows_without_new_input(spark, scratch):
    rows_in, rules_in = os.path.join(scratch, "rows"), os.path.join(scratch, "rules")
    os.makedirs(rules_in)
    _write_ordered(rows_in, [[envelope(i, "user" if i % 2 else "log", 10 + i) for i in range(12)]])
    rule_schema = T.StructType([*DIM_RULE.fields, T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType())])
    routed = route_cdc_stream(spark.readStream.schema(ENVELOPE).json(rows_in),
                              spark.readStream.schema(rule_schema).json(rules_in), slots=3, wait_ms=500)
    dims, facts = os.path.join(scratch, "dims"), os.path.join(scratch, "facts")
    writer = routed_batch_writer(dims, facts)
    q = (routed.writeStream.foreachBatch(writer).option("checkpointLocation", os.path.join(scratch, "ckpt"))
         .trigger(processingTime="300 milliseconds").start())

    def count(path, schema):
        try:
            return spark.read.schema(schema).json(path).count()
        except Exception:
            return 0

    try:
        wait_for(lambda: q.lastProgress is not None and q.lastProgress["batchId"] >= 1)
        assert count(f"{facts}/batch_id=*", ENVELOPE) == 0  # all wait
        with open(os.path.join(rules_in, "r.json"), "w") as f:
            f.write(json.dumps({"source_table": "user", "sink_table": "dim_user", "sink_family": "info", "sink_columns": "id,name",
                                "sink_row_key": "id", "op": "c", "ts_ms": 1}) + "\n")
        wait_for(lambda: count(f"{facts}/batch_id=*", ENVELOPE) == 6)
        wait_for(lambda: read_dim_table(spark, f"{dims}/dim_user", "row_key string, id string, name string").count() == 6)
    finally:
        q.stop()
    got = read_dim_table(spark, f"{dims}/dim_user", "row_key string, id string, name string").collect()
    assert sorted((r.row_key, r.id, r.name) for r in got) == sorted((str(i), str(i), "n") for i in range(1, 12, 2))
    tables = {r.source["table"] for r in spark.read.schema(ENVELOPE).json(f"{facts}/batch_id=*").collect()}
    assert tables == {"log"}


# ---- processing-time windows ----------------------------------------------------------
def test_a_processing_window_closes_without_new_input(spark, scratch):
    src = os.path.join(scratch, "in")
    _write_ordered(src, [[{"k": f"u{i % 3}", "seq": i, "os": "ios", "word": str(i)} for i in range(9)]])
    stream = spark.readStream.schema(EVENTS).json(src)
    out = last_per_processing_window(stream, "k", "2 seconds", ["seq"], "UTC")
    q = (out.writeStream.format("memory").queryName("pt_window").option("checkpointLocation", os.path.join(scratch, "ckpt"))
         .trigger(processingTime="200 milliseconds").start())
    try:
        wait_for(lambda: spark.table("pt_window").count() >= 3)
        time.sleep(1)
    finally:
        q.stop()
    rows = spark.table("pt_window").collect()
    assert sorted((r.k, r.seq) for r in rows) == [("u0", 6), ("u1", 7), ("u2", 8)]
    assert all(r.stt < r.edt and r.cur_date == r.stt[:10] for r in rows)


def test_processing_windows_keep_the_last_record():
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("seq", T.LongType())])
    p, clock = started(LastPerProcessingWindow(["seq"], 1000, schema), now=1200)
    assert list(p.handleInputRows(("a",), iter([Row(k="a", seq=5), Row(k="a", seq=3)]), clock)) == []
    assert list(p.handleInputRows(("a",), iter([Row(k="a", seq=4)]), clock)) == []
    assert clock.timers == [2000]
    clock.now = 2100  # the next record comes in the batch in which the timer is due
    out = list(p.handleInputRows(("a",), iter([Row(k="a", seq=1)]), clock))
    assert [(r.seq, r.window_start, r.window_end) for r in out] == [(5, 1000, 2000)]
    clock.now = 2000
    assert list(p.handleExpiredTimer(("a",), clock, clock)) == []  # that window is out already
    clock.now = 3000
    assert [r.seq for r in p.handleExpiredTimer(("a",), clock, clock)] == [1]


def test_without_a_watermark_no_row_is_late(spark, scratch):
    """TIM6: without a watermark a window counts every row, however late it comes (complete mode)."""
    from tidemart.operators.windows import window_aggregate, with_event_time

    base, src = 1_700_000_000_000, os.path.join(scratch, "in")
    _write_ordered(src, [[{"k": "a", "seq": base}], [{"k": "a", "seq": base + 86_400_000}], [{"k": "a", "seq": base + 1}]])
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).json(src)
    agg = window_aggregate(with_event_time(stream, "seq"), "et", "10 seconds", [], [F.count(F.lit(1)).alias("n")], tz="UTC")
    q = (agg.writeStream.format("memory").queryName("no_watermark").outputMode("complete")
         .option("checkpointLocation", os.path.join(scratch, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert sorted(r.n for r in spark.table("no_watermark").collect()) == [1, 2]


def test_console_sink_prints_batches(spark, scratch, capfd):
    """SNK7."""
    from tidemart.streaming.sinks import console_debug

    src = os.path.join(scratch, "in")
    _write_ordered(src, [[{"k": "seen on the console", "seq": 1}]])
    q = console_debug(spark.readStream.schema(EVENTS).json(src), os.path.join(scratch, "ckpt"))
    try:
        q.processAllAvailable()
        assert q.lastProgress is not None and q.exception() is None and "Console" in q.lastProgress["sink"]["description"]
    finally:
        q.stop()


# ---- retractions ----------------------------------------------------------------------
@pytest.mark.parametrize("lines", [1, 2])
def test_an_order_whose_lines_moved_counts_once(spark, scratch, lines):
    """All lines of order 1 move from province 0 to 1 in the same window: province 0 no longer has the order."""
    base = 1_700_000_000_000
    first = [{"id": f"d{i}", "order_id": 1, "province_id": 0, "split_total_amount": 10, "ts_ms": base + i} for i in range(lines)]
    first.append({"id": "stays", "order_id": 2, "province_id": 0, "split_total_amount": 7, "ts_ms": base})
    moved = [{**r, "province_id": 1, "ts_ms": r["ts_ms"] + 100} for r in first[:lines]]
    end = [{"id": "end", "order_id": 9, "province_id": 1, "split_total_amount": 0, "ts_ms": base + 3_600_000}]
    src = os.path.join(scratch, "in")
    _write_ordered(src, [first, moved, end])
    schema = "id string, order_id long, province_id long, split_total_amount long, ts_ms long"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(src)
    provinces = spark.createDataFrame([(0, "p0"), (1, "p1")], "id long, name string")
    out = run_stream(spark, province_window_stream(stream, provinces, "10 seconds", "5 seconds", "UTC"), scratch, f"moved{lines}")
    got = {r.province_id: (r.order_amount, r.order_count) for r in out.collect()}
    net = retract_dedupe(spark.read.schema(schema).json(src).where("id != 'end'"), "id", ["ts_ms"], ["split_total_amount"], net=True)
    want = {r.province_id: (r.a, r.c) for r in net.groupBy("province_id").agg(
        F.sum("split_total_amount").alias("a"), F.count_distinct("order_id").alias("c")).collect()}
    assert got == want == {0: (7, 1), 1: (10 * lines, 1)}
