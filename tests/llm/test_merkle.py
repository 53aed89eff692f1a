"""Merkle manifest against a plain tree, tampering, ties, many groups, several levels and sizes around the fanout."""

import random
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import docs_frame
from tidemart.llm import merkle


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes, fanout):
    """Top digest and, per node, the list of (left, right) sibling texts up to the top."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(place):
            run = at // fanout * fanout
            paths[i].append(("".join(nodes[run:at]), "".join(nodes[at + 1:run + fanout])))
        nodes = [h(*nodes[k:k + fanout]) for k in range(0, len(nodes), fanout)]
        place = [at // fanout for at in place]
    return nodes[0], paths


def plain(rows, fanout):
    groups = defaultdict(list)
    for i, text, source in rows:
        groups[source].append((i is not None, i, h(field(i), field(text))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in groups.values():
        g.sort(key=lambda r: (r[0], r[1] or 0, r[2]))
    lower = {s: tree([r[2] for r in groups[s]], fanout) for s in names}
    root, upper = tree([lower[s][0] for s in names], fanout) if names else (None, [])
    out = []
    for s, up in zip(names, upper):
        for (_, i, leaf), path in zip(groups[s], lower[s][1]):
            out.append((i, leaf, lower[s][0], root, h(*(a + b for a, b in path + up))))
    return sorted(out, key=repr)


def manifest(docs, fanout):
    rows = merkle.merkle_manifest(docs, merkle.record_digest(F.col("doc_id"), F.col("text")), fanout=fanout,
                                  carry={"other": merkle.record_digest(F.col("doc_id"), F.lower("text"))})
    return rows.select("doc_id", *[F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root")],
                       F.lower(F.hex(merkle.path_digest(F.col("path")))).alias("proof"),
                       (merkle.fold_path(F.col("leaf"), F.col("path")) == F.col("root")).alias("holds"),
                       (merkle.fold_path(F.col("other"), F.col("path")) == F.col("root")).alias("other_holds"), "other", "leaf")


def check(spark, rows, fanout):
    got = manifest(docs_frame(spark, rows), fanout).collect()
    assert sorted([tuple(r)[:5] for r in got], key=repr) == plain(rows, fanout)
    assert all(r["holds"] for r in got)
    texts = defaultdict(set)
    for i, t, _ in rows:
        texts[i].add(t == (t or "").lower() or t is None)
    for r in got:
        if len(texts[r["doc_id"]]) == 1:
            assert r["other_holds"] == texts[r["doc_id"]].copy().pop()


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_equals_a_plain_tree(spark, fanout):
    rng = random.Random(fanout)
    rows = [(i, rng.choice([None, "", "Abc é", "abc", f"t{i}"]), rng.choice([None, "", "a", "B", "é", "hot", "hot"]))
            for i in range(150)]
    check(spark, rows, fanout)


def test_sizes_around_the_fanout_and_over_many_chunks(spark):
    """Groups of a leaf, a run, a run of runs, one more of each, and of more leaves than a window chunk holds."""
    sizes = [1, 2, 16, 17, 256, 257, 3 * 16 * merkle.CHUNK_RUNS + 5]
    check(spark, [(i, f"T{i}", f"s{n}") for n in sizes for i in range(n)], 16)


@pytest.mark.parametrize("n", [1, 17])
def test_one_group(spark, n):
    check(spark, [(i, f"T{i}", "one") for i in range(n)], 16)


def test_repeated_rows_null_ids_and_many_groups(spark):
    rows = [(5, "same", "a")] * 40 + [(None, "x", "a"), (None, None, None)] + [(5, "other", "a")] * 3
    check(spark, rows + [(i, "t", f"g{i}") for i in range(60)], 4)


def test_empty_table(spark):
    assert manifest(docs_frame(spark, []), 16).collect() == []


def test_no_window_holds_a_whole_group(spark):
    """Nodes of a hot group are dealt over chunks: no window partition has more than fanout * CHUNK_RUNS rows."""
    nodes = spark.range(10_000).select(F.lit(0).cast("bigint").alias("g"), F.col("id").alias("pos"),
                                       F.lit(10_000).cast("bigint").alias("n"), merkle.digest(F.col("id").cast("string")).alias("node"))
    from tidemart.llm.common import Scratch

    levels = merkle._levels(nodes, 4, Scratch(spark, "t"))
    assert [t.count() for t in levels] == [10_000, 2500, 625, 157, 40, 10, 3, 1]
    from contextlib import redirect_stdout
    from io import StringIO

    text = StringIO()
    with redirect_stdout(text):
        merkle.merkle_manifest(docs_frame(spark, [(1, "a", "x")]), merkle.record_digest(F.col("doc_id"))).explain()
    assert "Window" not in text.getvalue()  # the plan that is left joins written levels only
