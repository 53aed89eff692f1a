"""SimHash, fuzzy lines, substrings and embeddings against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import components, docs_frame, words
from tidemart.llm import embeddings
from tidemart.llm.common import Scratch, connected_components, maybe_in
from tidemart.llm.embeddings import embedding_near_dedup
from tidemart.llm.lines import _in_several, drop_fuzzy_lines, line_dedup
from tidemart.llm.simhash import covering_masks, drop_near_copies, fingerprint, simhash_near_dedup
from tidemart.llm.substrings import DIFFERENCE_COVERS, substring_dedup, window_hashes

FEW = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
VOCAB = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa", "la", "mu"]


def prose(rng, n):
    return " ".join(rng.choice(VOCAB) + str(rng.randrange(60)) for _ in range(n))


# ---- components ---------------------------------------------------------------------
@FEW
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
def test_connected_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected_components(df, "a", "b", Scratch(spark, "t")).collect()}
    real = [(a, b) for a, b in edges if a != b]
    want = components({n for e in real for n in e}, real)
    assert got == want


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 500)] + [(None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected_components(df, "a", "b", Scratch(spark, "t")).collect()}
    assert {got[i] for i in range(201)} == {0} and {got[1000 + i] for i in range(500)} == {1000}


# ---- SimHash ------------------------------------------------------------------------
def plain_fingerprint(text, k=4):
    w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in words(text)]
    if not w:
        return 0
    grams = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a b c", "A b C d", "x y z w v u t", "Äb Çd e f\x0bg h i j " * 40])
def test_fingerprint(text):
    assert fingerprint(text, 4) == plain_fingerprint(text)


def test_covering_masks_cover_every_difference_of_radius():
    for radius in (1, 2, 4):
        masks = [m & (2 ** 64 - 1) for m in covering_masks(radius)]
        assert len(masks) == 2 ** (radius + 1) - 1
        rng = random.Random(radius)
        for _ in range(20_000):
            diff = sum(1 << b for b in rng.sample(range(64), radius))
            assert any(diff & m == 0 for m in masks)


def near_copies(rng, n=40):
    rows, i = [], 0
    for _ in range(n):
        base = prose(rng, rng.choice([3, 20, 200])).split()
        for _ in range(rng.choice([1, 2, 4])):
            w = list(base)
            if rng.random() < 0.6 and len(w) > 10:
                w[rng.randrange(len(w))] = "changed"
            rows.append((i, " ".join(w)))
            i += 1
    return rows


def test_simhash_components_match_brute_force(spark):
    rng = random.Random(3)
    rows = near_copies(rng) + [(900, None), (901, ""), (902, " \n "), (5, rows_text := "one two"), (5, rows_text), (None, rows_text)]
    fps = {}
    for i, t in rows:
        fps.setdefault(plain_fingerprint(t), set()).add(i)
    keys = list(fps)
    linked = [(a, b) for a in keys for b in keys if a < b and (a ^ b).bit_count() <= 4]
    comp = components(keys, linked)
    least = {}
    for k in keys:
        ids = [i for i in fps[k] if i is not None]
        if ids:
            least[comp[k]] = min(min(ids), least.get(comp[k], min(ids)))
    want = sorted(((str(i), f"{plain_fingerprint(t):016x}", least[comp[plain_fingerprint(t)]]) for i, t in rows))
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in simhash_near_dedup(docs_frame(spark, rows)).collect())
    assert got == want
    kept = drop_near_copies(docs_frame(spark, rows))
    assert kept.columns == docs_frame(spark, rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(least.values())


def test_simhash_hot_group_of_near_copies(spark):
    """A third of all rows in one group: all joined, and the rest left alone."""
    rng = random.Random(5)
    base = prose(rng, 400).split()
    rows = [(i, " ".join(base[:i % 300] + ["edit"] + base[i % 300 + 1:])) for i in range(100)]
    rows += [(1000 + i, prose(rng, 50)) for i in range(200)]
    got = simhash_near_dedup(docs_frame(spark, rows)).collect()
    fps = {r[0]: plain_fingerprint(r[1]) for r in rows}
    ids = list(fps)
    want = components(ids, [(a, b) for a in ids for b in ids if a < b and (fps[a] ^ fps[b]).bit_count() <= 4])
    assert {r.doc_id: r.component_id for r in got} == want


# ---- fuzzy lines --------------------------------------------------------------------
def line_sets(text, q=9):
    t = " ".join(words(text)).lower()
    return {t} if len(t) <= q else {t[i:i + q] for i in range(len(t) - q + 1)}


def plain_line_dedup(rows):
    """(doc_id, text) rows of distinct ids -> doc_id -> places of removed lines."""
    lines = [(i, n, ln) for i, t in rows for n, ln in enumerate((t or "").split("\n")) if words(ln)]
    sets = [line_sets(ln) for _, _, ln in lines]
    links = [(a, b) for a in range(len(lines)) for b in range(a) if
             len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    comp = components(range(len(lines)), links)
    first = {}
    for k, (i, n, _) in enumerate(lines):
        c = comp[k]
        if c not in first or (i, n) < first[c]:
            first[c] = (i, n)
    out = {i: [] for i, _ in rows}
    for k, (i, n, _) in enumerate(lines):
        if first[comp[k]] != (i, n):
            out[i].append(n)
    return out


def line_rows(rng):
    pool = [prose(rng, rng.choice([1, 6, 25, 60])) for _ in range(25)]
    rows = []
    for i in range(40):
        ls = []
        for _ in range(rng.randrange(1, 6)):
            ln = rng.choice(pool)
            if rng.random() < 0.4 and len(ln) > 100:
                at = rng.randrange(len(ln) - 5)
                ln = ln[:at] + "#" + ln[at + 1:]
            ls.append(rng.choice(["", "  "]) + (ln.upper() if rng.random() < 0.2 else ln))
            if rng.random() < 0.2:
                ls.append(" ")
        rows.append((i, "\n".join(ls)))
    return rows + [(100, None), (101, ""), (102, "ß"), (103, "ß\nß"), (104, "é" * 30000)]


def test_line_dedup_matches_brute_force(spark):
    rows = line_rows(random.Random(8))
    want = plain_line_dedup(rows)
    got = {r.doc_id: r for r in line_dedup(docs_frame(spark, rows)).collect()}
    assert {i: r.removed_lines for i, r in got.items()} == {i: ",".join(map(str, v)) for i, v in want.items()}
    assert all(r.n_removed == len(want[i]) for i, r in got.items())
    cut = {r.doc_id: r.text for r in drop_fuzzy_lines(docs_frame(spark, rows)).collect()}
    for i, t in rows:
        if t is not None:
            assert cut[i] == "\n".join(x for n, x in enumerate(t.split("\n")) if n not in want[i])
    assert cut[100] is None


def test_line_dedup_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(1, "same line here"), (1, "same line here"), (None, "same line here"), (0, "another one")]
    got = sorted((str(r.doc_id), r.n_lines, r.removed_lines) for r in line_dedup(docs_frame(spark, rows)).collect())
    assert got == [("0", 1, ""), ("1", 1, ""), ("1", 1, ""), ("None", 1, "0")]
    assert line_dedup(docs_frame(spark, [])).collect() == []


def test_line_dedup_finds_short_lines_at_the_threshold(spark):
    rng, rows = random.Random(3), []
    for t in range(1, 11):  # 12 to 48 characters, and t more: 4t of 5t shingles in common
        for _ in range(400):
            first = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8 + 4 * t))
            rows.append((len(rows), first + "\n" + first + "".join(rng.choice("0123456789") for _ in range(t))))
    for _, text in rows:
        a, b = map(line_sets, text.split("\n"))
        assert len(a & b) == 0.8 * len(a | b)
    got = {r.doc_id: r.removed_lines for r in line_dedup(docs_frame(spark, rows)).collect()}
    missed = [got[i] != "1" for i, _ in rows]
    print("missed of 400 by size of the union / 5:", [sum(missed[k:k + 400]) for k in range(0, 4000, 400)])
    assert sum(missed) < 32 and sum(missed[:800]) < 10  # 8 bands of 3 independent rows: 12.8 and 2.6 are expected


def test_band_keys_of_one_line_are_dropped_before_their_rows_are_shuffled(spark):
    scratch = Scratch(spark, "t")
    rows = scratch.table(spark.range(4000).select(F.xxhash64("id").alias("k"), F.col("id").alias("h1"), F.lit(1).alias("h2")), "m")
    several = scratch.table(spark.range(0, 4000, 400).select(F.xxhash64("id").alias("s_k")), "s")
    got = _in_several(rows, several)
    assert sorted(r.h1 for r in got.collect()) == list(range(0, 4000, 400)) and got.columns == rows.columns
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan  # it would be moved below the bitmap
    assert plan.index("s_k") < plan.index("_row_block")  # the join comes after the bitmap


def test_a_stranger_in_a_large_bucket_costs_one_pass(spark):
    """Of a bucket with n linked nodes and one stranger, n pairs are held against the condition after the pivot step."""
    from tidemart.llm.common import Scratch, connected_components, link_buckets

    n = 3000
    members = spark.range(n + 1).select(F.lit(1).alias("k"), F.when(F.col("id") < n, F.col("id")).otherwise(1 << 40).alias("x"),
                                        F.lit(5).cast("bigint").alias("p"))
    scratch, asked = Scratch(spark, "t"), []

    def verify(pairs):
        asked.append(pairs.count())
        return pairs.where("b < 1000000")

    got = link_buckets(scratch.table(members, "m"), ["k"], lambda a, b: F.lit(True), scratch, verify)
    assert asked == [n, n - 1]  # every member against the pivot, then the stranger against the others
    assert {r.component for r in got.collect()} == {0} and got.count() == n
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b", scratch).collect() == []


def test_a_bucket_of_many_linked_components_is_not_paired(spark):
    """Each node of a bucket links to a quarter of the others: its pivot joins a few, grouped pivots the rest; nodes that
    link to nothing stay apart, and a pair that shares several buckets is asked for once."""
    from tidemart.llm.common import link_buckets

    n = 1600
    rows = spark.range(n + 5).select(F.explode(F.array(F.lit(1), F.lit(2))).alias("k"), F.when(F.col("id") < n, F.col("id")).otherwise(
        F.col("id") * 1_000_000).alias("x"), F.lit(5).cast("bigint").alias("p"))
    scratch, asked = Scratch(spark, "t"), []

    def verify(pairs):
        asked.append(pairs.count())
        return pairs

    got = link_buckets(scratch.table(rows, "m"), ["k"], lambda a, b: F.abs(F.col(a) - F.col(b)) <= n // 8, scratch, verify)
    assert sorted((r.node, r.component) for r in got.collect()) == [(i, 0) for i in range(n)]
    print("pairs asked for:", asked)
    assert sum(asked) < 10 * n  # 240,000 if all members outside the pivot's component were paired


def test_link_buckets_matches_brute_force(spark):
    """Several buckets and keys, links through other buckets, near pairs that do not link, and dealt groups."""
    from tidemart.llm.common import bucket_pivots, link_buckets

    rng = random.Random(4)
    nodes = rng.sample(range(1 << 20), 600)
    where = {x: {(t, rng.randrange(3)) for t in range(3)} for x in nodes}
    near = lambda a, b: abs(a - b) <= 4000
    links = [(a, b) for a in nodes for b in nodes if a < b and where[a] & where[b] and near(a, b) and (a + b) % 3]
    want = components(nodes, links)
    linked = {x for e in links for x in e}
    scratch = Scratch(spark, "t")
    members = spark.createDataFrame([(t, k, x) for x, s in where.items() for t, k in s], "t int, k int, x bigint")
    shared = scratch.table(bucket_pivots(members, ["t", "k"], "x"), "shared")
    got = link_buckets(shared, ["t", "k"], lambda a, b: F.abs(F.col(a) - F.col(b)) <= 4000, scratch,
                       lambda pairs: pairs.where("(a + b) % 3 != 0"))
    got = [(r.node, r.component) for r in got.collect()]
    assert len(got) == len(linked) and dict(got) == {x: want[x] for x in linked}


# ---- substrings ---------------------------------------------------------------------
def test_difference_covers():
    for p, d in DIFFERENCE_COVERS.items():
        assert {(a - b) % p for a in d for b in d} == set(range(p))


def test_window_hashes_depend_on_words_and_order_only():
    rng = np.random.default_rng(1)
    w = rng.integers(0, 5, 300).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for m in (1, 2, 3, 7, 15, 35):
        seen = {}
        for i, h in enumerate(window_hashes(w, m).tolist()):
            assert seen.setdefault(h, tuple(w[i:i + m])) == tuple(w[i:i + m])
        assert len(seen) == len({tuple(w[i:i + m]) for i in range(len(w) - m + 1)})


def plain_substring(rows, length):
    all_, out = {}, []
    for r, (_, t) in enumerate(rows):
        w = words(t)
        for s in range(len(w) - length + 1):
            all_.setdefault(tuple(w[s:s + length]), []).append((r, s))
    gone = [set() for _ in rows]
    for places in all_.values():
        if len(places) > 1:
            for r, s in places:
                gone[r].update(range(s, s + length))
    for r, (i, t) in enumerate(rows):
        w = words(t)
        kept = " ".join(x for k, x in enumerate(w) if k not in gone[r])
        out.append((str(i), len(w), len(gone[r]), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def check_substrings(spark, rows, length, period, parts=3):
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in
                 substring_dedup(docs_frame(spark, rows, parts), length, period).collect())
    assert got == plain_substring(rows, length)


@FEW
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=60), min_size=1, max_size=6), st.sampled_from([(9, 7), (14, 13)]))
def test_substring_dedup_on_tiny_alphabets(spark, texts, sizes):
    check_substrings(spark, [(i, " ".join(t)) for i, t in enumerate(texts)], *sizes)


def test_substring_dedup_passages(spark):
    rng = random.Random(4)
    passages = [prose(rng, n) for n in (34, 35, 36, 50, 51, 80, 300)]
    rows = []
    for i in range(30):
        parts = [prose(rng, rng.randrange(0, 70))]
        for _ in range(rng.randrange(0, 3)):
            parts += [rng.choice(passages), prose(rng, rng.randrange(0, 40))]
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(parts)))
    rows += [(50, None), (51, ""), (52, "one word"), (53, passages[4]), (53, passages[4]), (None, "a\x1cb " * 40),
             (54, prose(rng, 60_000)), (55, "w" * 3_000_000 + " " + passages[5])]
    check_substrings(spark, rows, 35, 21)
    check_substrings(spark, rows, 35, 21, parts=1)  # all findings repeat within one batch
    assert substring_dedup(docs_frame(spark, [])).collect() == []


# ---- embeddings ---------------------------------------------------------------------
def test_embedding_dedup_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    rows, i = [], 0
    for label in (0, 1):
        for _ in range(40):
            v = rng.standard_normal(24)
            for _ in range(rng.integers(1, 4)):
                w = v + rng.standard_normal(24) * rng.choice([0.0, 0.05, 0.14, 0.3])
                rows.append((i, (w * rng.choice([1.0, 3.0])).tolist(), label))
                i += 1
    hot = rng.standard_normal(24)
    rows += [(i + k, (hot + rng.standard_normal(24) * 0.02).tolist(), 0) for k in range(120)]
    nan, inf = float("nan"), float("inf")
    rows += [(5000, None, 0), (5001, [0.0] * 24, 0), (5002, [nan] * 24, 0), (5003, [1.0, None] + [0.0] * 22, 0),
             (5004, [inf] * 24, 0), (5005, hot.tolist(), None), (5006, [1.0, 2.0], 0), (5007, [2.0, 4.0], 0), (5008, [], 0)]
    rows += [rows[0], (None, rows[0][1], rows[0][2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("node", F.lit("x"))
    good = [k for k, (_, v, lab) in enumerate(rows) if v and lab is not None and all(
        x is not None and np.isfinite(x) for x in v) and any(v)]

    def cosine(a, b):
        a, b = np.array(rows[a][1]), np.array(rows[b][1])
        return len(a) == len(b) and float(a @ b / np.sqrt((a @ a) * (b @ b))) >= 0.98

    links = [(a, b) for a in good for b in good if a < b and rows[a][2] == rows[b][2] and cosine(a, b)]
    comp = components(range(len(rows)), links)
    degree = [0] * len(rows)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[comp[k]] = min(r[0], least.get(comp[k], r[0]))
    want = sorted((str(r[0]), degree[k], str(least.get(comp[k]))) for k, r in enumerate(rows))
    for block_rows in (1000, 16):
        got = sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in
                     embedding_near_dedup(df, block_rows=block_rows).collect())
        assert got == want
    assert embedding_near_dedup(df.limit(0)).collect() == []


def test_embedding_labels_do_not_run_into_components(spark):
    rows = [(1, [1.0, 2.0], "a"), (2, [2.0], "a,1.0"), (3, [1.0, 2.0], "a"), (4, [3.0], ""), (5, [3.0], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_near_dedup(df).collect()}
    assert got == {1: (1, 1), 2: (0, 2), 3: (1, 1), 4: (0, 4), 5: (0, 5)}


def test_embedding_batches_stay_small_with_a_hot_bucket(spark, monkeypatch):
    rng = np.random.default_rng(6)
    hot = rng.standard_normal(24)
    vectors = [hot + rng.standard_normal(24) * 0.002 for _ in range(300)] + list(rng.standard_normal((600, 24)))
    x = np.stack(vectors) / np.linalg.norm(vectors, axis=1)[:, None]
    want = {i: int(n) - 1 for i, n in enumerate((x @ x.T >= 0.98).sum(axis=1))}
    real = embeddings._compare

    def bounded(threshold):
        run = real(threshold)

        def counted(key: tuple, frame):
            assert len(frame) <= 20_000, f"{len(frame)} rows in one batch"
            return run(key, frame)
        return counted

    monkeypatch.setattr(embeddings, "_compare", bounded)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)],
                               "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in embedding_near_dedup(df, block_rows=10).collect()}
    assert got == want and want[0] == 299


def test_the_bitmap_filter_loses_nothing(spark):
    rows = spark.range(5000).select(F.xxhash64("id").alias("x"), "id")
    nodes = rows.where("id % 50 = 0").select("x")
    kept = {r.id for r in maybe_in(rows, nodes, "x").collect()}
    assert kept >= set(range(0, 5000, 50)) and len(kept) < 110
    assert maybe_in(rows, nodes.limit(0), "x").count() == 0
