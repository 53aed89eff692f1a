"""Keyed-state operators (batch form) against per-record Python models, on random event lists."""

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemart.operators.stateful import (composite_dedupe, exact_dedupe, first_per_key, keyed_lag, last_per_key,
                                         new_visitor_fix, retract_dedupe, retract_dedupe_ttl, visit_flags)
from tidemart.operators.windows import daily_first
from tidemart.sources.dims import merge_cells

D0 = dt.date(2024, 1, 1)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

events = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4), st.sampled_from(["0", "1"]),
                            st.integers(-50, 50), st.integers(0, 40)), min_size=1, max_size=40)


def frame(spark, evs):
    rows = [(i, k, D0 + dt.timedelta(days=d), n, a, t * 1000) for i, (k, d, n, a, t) in enumerate(evs)]
    return spark.createDataFrame(rows, "seq long, k long, d date, is_new string, amt long, t long"), rows


@SETTINGS
@given(events)
def test_new_visitor_fix(spark, evs):
    df, rows = frame(spark, evs)
    got = {r.seq: r.is_new for r in new_visitor_fix(df, "k", ["seq"], "d").collect()}
    state, want = {}, {}
    for seq, k, d, n, _, _ in rows:
        if k not in state:
            state[k] = d if n == "1" else d - dt.timedelta(days=1)
            want[seq] = n
        else:
            want[seq] = "0" if (n == "1" and state[k] != d) else n
    assert got == want


@SETTINGS
@given(events)
def test_visit_flags(spark, evs):
    df, rows = frame(spark, evs)
    df = df.withColumn("lp", F.when(F.col("amt") > 0, F.lit("home")))
    got = {r.seq: (r.uv_ct, r.sv_ct, r.pv_ct) for r in visit_flags(df, "k", ["d", "seq"], "d", "lp").collect()}
    last, want = {}, {}
    for seq, k, d, _, a, _ in sorted(rows, key=lambda r: (r[2], r[0])):  # arrival starts with time, ids need not follow it
        want[seq] = (1 if last.get(k) != d else 0, 0 if a > 0 else 1, 1)
        last[k] = d
    assert got == want


@SETTINGS
@given(events)
def test_keyed_lag_split_equals_plain(spark, evs):
    df, _ = frame(spark, evs)
    plain = {r.seq: r.prev_amt for r in keyed_lag(df, "k", ["seq"], ["amt"]).collect()}
    split = {r.seq: r.prev_amt for r in keyed_lag(df, "k", ["seq"], ["amt"], range_width=3).collect()}
    assert plain == split


@SETTINGS
@given(events)
def test_retract_dedupe(spark, evs):
    df, rows = frame(spark, evs)
    got = Counter((r.k, r.seq, r.amt, r.sign) for r in retract_dedupe(df, "k", ["seq"], ["amt"]).collect())
    prev, want = {}, Counter()
    for seq, k, _, _, a, _ in rows:
        if k in prev:
            want[(k, prev[k][0], -prev[k][1], -1)] += 1
        want[(k, seq, a, 1)] += 1
        prev[k] = (seq, a)
    assert got == want
    # the net sum per key equals the last row's amount
    net = Counter()
    for (k, _, a, _), c in got.items():
        net[k] += a * c
    assert dict(net) == {k: v[1] for k, v in prev.items()} or all(v[1] == net[k] for k, v in prev.items())


@SETTINGS
@given(events, st.integers(0, 20_000))
def test_retract_dedupe_ttl(spark, evs, ttl):
    df, rows = frame(spark, evs)
    df = df.orderBy("seq")
    got = Counter((r.k, r.seq, r.amt, r.sign) for r in retract_dedupe_ttl(df, "k", ["seq"], ["amt"], "t", ttl).collect())
    prev, want = {}, Counter()
    for seq, k, _, _, a, t in rows:
        if k in prev and t - prev[k][2] <= ttl:
            want[(k, prev[k][0], -prev[k][1], -1)] += 1
        want[(k, seq, a, 1)] += 1
        prev[k] = (seq, a, t)
    assert got == want


@SETTINGS
@given(events)
def test_first_last_daily(spark, evs):
    df, rows = frame(spark, evs)
    first = {r.k: r.seq for r in first_per_key(df, "k", ["seq"]).collect()}
    last = {r.k: r.seq for r in last_per_key(df, "k", ["seq"]).collect()}
    wf, wl = {}, {}
    for seq, k, *_ in rows:
        wf.setdefault(k, seq)
        wl[k] = seq
    assert first == wf and last == wl
    got = {(r.k, r.d): r.seq for r in daily_first(df, "k", "d", ["seq"], "t").collect()}
    per_day = {}
    for seq, k, d, _, _, t in rows:
        per_day.setdefault((k, d), (seq, t))
    want, prev_t = {}, {}
    for (k, d) in sorted(per_day):
        seq, t = per_day[(k, d)]
        if k not in prev_t or t >= prev_t[k]:
            want[(k, d)] = seq
        prev_t[k] = t
    assert got == want


def test_exact_and_composite_dedupe(spark):
    df = spark.createDataFrame([(1, "a", {"x": "1"}), (1, "a", {"x": "1"}), (1, "a", {"x": "2"}), (2, "b", None)],
                               "u long, v string, m map<string,string>")
    assert exact_dedupe(df).count() == 3
    ev = spark.createDataFrame([(0, 1, 7), (1, 1, 7), (2, 1, 8), (3, 2, 7)], "seq long, a long, b long")
    assert sorted(r.seq for r in composite_dedupe(ev, "a", "b", ["seq"]).collect()) == [0, 2, 3]
    odd = spark.createDataFrame([(0, None, "x"), (1, "x", None), (2, "a_b", "c"), (3, "a", "b_c"), (4, "x", None)],
                                "seq long, a string, b string")
    assert sorted(r.seq for r in composite_dedupe(odd, "a", "b", ["seq"]).collect()) == [0, 1, 2, 3]


def test_retract_dedupe_repeats_and_nulls(spark):
    """An exact repeat retracts its first record; rows without an id retract each other like any id."""
    rows = [(1, 5, 10), (1, 5, 10), (None, 1, 3), (None, 2, 4), (2, 1, None), (2, 2, 7)]
    df = spark.createDataFrame(rows, "k long, seq long, amt long")
    got = Counter((r.k, r.amt, r.sign) for r in retract_dedupe(df, "k", ["seq"], ["amt"]).collect())
    assert got == Counter({(1, 10, 1): 2, (1, -10, -1): 1, (None, 3, 1): 1, (None, -3, -1): 1, (None, 4, 1): 1,
                           (2, None, 1): 1, (2, None, -1): 1, (2, 7, 1): 1})


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["c", "u", "d"]), st.sampled_from(["", "x", "y", None]),
                          st.sampled_from(["", "p", None])), min_size=1, max_size=25))
def test_merge_cells(spark, changes):
    rows = [(k, i, op, a if op != "d" else None, b if op != "d" else None) for i, (k, op, a, b) in enumerate(changes)]
    df = spark.createDataFrame(rows, "k long, seq long, op string, a string, b string")
    got = {r.k: (r.a, r.b) for r in merge_cells(df, "k", ["seq"], ["a", "b"]).collect()}
    state = {}
    for k, _, op, a, b in rows:
        if op == "d":
            state.pop(k, None)
            continue
        cur = state.setdefault(k, [None, None])
        if a:
            cur[0] = a
        if b:
            cur[1] = b
    assert got == {k: tuple(v) for k, v in state.items()}
