"""Scans over ranges: previous rows, visit flags and running profiles against a plain loop, with hot and null keys."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemart.operators.scan import ordered_rows, previous_row, running_profile_records
from tidemart.operators.stateful import visit_flags

SCHEMA = "k string, t long, os string, word string, m map<string,string>"


def make(spark, rows):
    return spark.createDataFrame([(*r, {"a": "b"}) for r in rows], SCHEMA).repartition(5)


def rows_with_hot_key(n=600, seed=1):
    rng = random.Random(seed)
    keys = ["-1"] * 10 + [None] * 3 + [f"u{i}" for i in range(12)]
    return [(rng.choice(keys), rng.randrange(n // 3), rng.choice(["ios", "and", None]), rng.choice([None, "", f"w{rng.randrange(40)}"]))
            for _ in range(n)]


def arrival(r):
    return tuple((x is not None, x) for x in r[1:])


def plain_profile(rows):
    out, n, sets = Counter(), Counter(), {}
    for r in sorted(rows, key=arrival):
        k = r[0]
        n[k] += 1
        oses, words = sets.setdefault(k, (set(), set()))
        oses.update([r[2]] if r[2] is not None else [])
        words.update([r[3]] if r[3] is not None else [])
        out[(*r, n[k], ",".join(sorted(oses)), ",".join(sorted(words)))] += 1
    return out


@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_profile_of_every_record(spark, ranges):
    rows = rows_with_hot_key()
    rows += rows[:30]  # whole repeats
    got = running_profile_records(make(spark, rows), "k", ["t"], ["os", "word"], ranges=ranges)
    assert got.columns == ["k", "t", "os", "word", "m", "page_count", "os_set", "word_set"]
    seen = Counter((r.k, r.t, r.os, r.word, r.page_count, r.os_set, r.word_set) for r in got.collect())
    assert seen == plain_profile(rows)


def test_profile_of_nothing_and_of_one_key(spark):
    assert running_profile_records(make(spark, []), "k", ["t"], ["os"]).collect() == []
    rows = [("-1", i, "ios", f"w{i % 9}") for i in range(200)]
    got = running_profile_records(make(spark, rows), "k", ["t"], ["os", "word"], ranges=16)
    assert Counter((r.k, r.t, r.os, r.word, r.page_count, r.os_set, r.word_set) for r in got.collect()) == plain_profile(rows)


@pytest.mark.parametrize("ranges", [1, 9])
def test_previous_row(spark, ranges):
    rows = rows_with_hot_key(seed=2)
    got = previous_row(ordered_rows(make(spark, rows), "k", ["t"], ranges), "k", ["t", "word"])
    last, want = {}, Counter()
    for r in sorted(rows, key=arrival):
        want[(*r, *last.get(r[0], (None, None)))] += 1
        last[r[0]] = (r[1], r[3])
    assert Counter((r.k, r.t, r.os, r.word, r.prev_t, r.prev_word) for r in got.collect()) == want


def test_a_hot_key_covers_many_ranges(spark):
    """A third of the rows have one key: no range holds more than a few hundredths of them."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit("-1")).otherwise(F.col("id").cast("string")).alias("k"),
                                    (F.col("id") * 7919 % 30_011).alias("t"))
    rows = ordered_rows(df, "k", ["t"], 32)
    hot = [r["count"] for r in rows.where("k = '-1'").groupBy("_range").count().collect()]
    assert sum(hot) == 10_000 and max(hot) < 2_000
    sizes = [r["count"] for r in rows.groupBy("_range").count().collect()]
    assert max(sizes) < 2_000


@pytest.mark.parametrize("ranges", [1, 8])
def test_visit_flags_follow_arrival_not_time(spark, ranges):
    """A date that comes back counts again; rows of equal arrival: one is first; a null date is a date of its own."""
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", None, "a"]), rng.randrange(60), rng.choice(["d1", "d2", None]), rng.choice(["", None, "home"]))
            for _ in range(200)]
    got = visit_flags(make(spark, rows), "k", ["t"], "os", "word", ranges=ranges)
    last, want = {}, Counter()
    for r in sorted(rows, key=arrival):
        want[(*r, int(r[0] not in last or last[r[0]] != r[2]), int(not r[3]))] += 1
        last[r[0]] = r[2]
    assert Counter((r.k, r.t, r.os, r.word, r.uv_ct, r.sv_ct) for r in got.collect()) == want


def test_two_rows_of_equal_arrival_are_one_visit(spark):
    rows = [("a", 5, "d1", "home"), ("a", 5, "d1", "home"), ("a", 5, "d1", None)]
    assert sum(r.uv_ct for r in visit_flags(make(spark, rows), "k", ["t"], "os", "word").collect()) == 1
