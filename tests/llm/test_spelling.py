"""Spelling variants against brute force: near pairs, counts, planted errors, forms, roots, cut buckets."""

import random
import re
import zlib
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.llm.helpers import docs_frame
from tidemart.llm import spelling

FEW = settings(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))
SMALL = str.maketrans(spelling.UPPER, spelling.LOWER)


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(vocab, ratio=2):
    out, form = {}, {}
    for w, n in vocab.items():
        others = [(-m, v) for v, m in vocab.items() if near(w, v)]
        best = min(others, default=None)
        form[w] = best[1] if best and -best[0] >= ratio * n else None
        out[w] = (n, len(others))
    rows = []
    for w, (n, k) in out.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, k, vocab[form[w]] if form[w] else None))
    return sorted(rows)


def plain_counts(rows, every):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(SMALL)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def groups(spark, vocab, **kw):
    frame = spark.createDataFrame([(w, n) for w, n in vocab.items()], "word string, n long").repartition(3)
    return sorted(map(tuple, spelling.spelling_groups(frame, **kw).collect()))


@FEW
@given(st.lists(st.text("abé", min_size=1, max_size=6), min_size=1, max_size=40, unique=True))
def test_index_finds_exactly_the_near_words(words):
    for length in {len(w) for w in words}:
        queries = [w for w in words if len(w) == length]
        there = [w for w in words if len(w) in (length, length + 1)]
        got = Counter((queries[i], there[j]) for q, w in spelling.near_pairs(
            [x.encode("latin-1") for x in queries], [x.encode("latin-1") for x in there]) for i, j in zip(q, w))
        assert got == Counter((a, b) for a in queries for b in there if near(a, b))


def vocabulary(rng, letters, n, longest):
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(3, longest))) for _ in range(n)}
    return {w: rng.choice([3, 3, 4, 6, 12, 24, 48]) for w in words}


def test_groups_equal_brute_force(spark):
    rng = random.Random(3)
    vocab = vocabulary(rng, "abc", 250, 9) | vocabulary(rng, "xyzßé÷", 150, 8)
    vocab["q" * 300], vocab["q" * 301], vocab["q" * 150 + "r" + "q" * 150] = 3, 9, 4
    assert groups(spark, vocab) == plain(vocab)


def test_cut_buckets_lose_and_repeat_no_pair(spark):
    """All words share their first half: one bucket, cut into pairs of blocks of some 20 words."""
    rng = random.Random(4)
    vocab = {"prefix" + w: n for w, n in vocabulary(rng, "ab", 200, 8).items()}
    assert groups(spark, vocab, block_rows=20) == plain(vocab)


def test_chunks_of_index_and_queries(spark, monkeypatch):
    monkeypatch.setattr(spelling, "INDEX_WORDS", 7)
    monkeypatch.setattr(spelling, "QUERY_WORDS", 5)
    words = sorted(vocabulary(random.Random(5), "ab", 120, 8))
    for length in (4, 5):
        queries, there = [w for w in words if len(w) == length], [w for w in words if len(w) in (length, length + 1)]
        got = Counter((queries[i], there[j]) for q, w in spelling.near_pairs(
            [x.encode() for x in queries], [x.encode() for x in there]) for i, j in zip(q, w))
        assert got == Counter((a, b) for a in queries for b in there if near(a, b))


def test_roots_follow_long_chains(spark):
    """Each word is one letter from the next, whose count is twice as large."""
    words = ["a" * (12 - k) + "b" * k for k in range(13)]
    vocab = {w: 3 << k for k, w in enumerate(words)}
    got = {r[0]: r[2] for r in groups(spark, vocab)}
    assert set(got.values()) == {"b" * 12}
    assert groups(spark, vocab) == plain(vocab)


def test_ties_take_the_smallest_word(spark):
    vocab = {"aaaaa": 3, "aaaab": 9, "aaaac": 9, "zaaaa": 6, "éaaaa": 9}
    got = {r[0]: r for r in groups(spark, vocab)}
    assert got["aaaaa"][1:3] == ("aaaab", "aaaab") and got["zaaaa"][1] is None and got["aaaaa"][4] == 4


def test_counts_with_planted_errors_and_edge_cases(spark):
    rng = random.Random(6)
    texts = ["Größe größe GRÖSSE GRÖßE", "word-words Wordé÷x", None, "", "x" * 70_000 + " abcde ABCDE KKbcdef"]
    rows = [(rng.choice([None, *range(40)]), rng.choice(texts) if rng.random() < 0.5 else
             " ".join(rng.choice(["Apples", "apples", "Orange", "naïveté", "cat", "NAÏVETÉ"]) for _ in range(30))) for _ in range(90)]
    rows += rows[:10]
    for every in (None, 3):
        got = spelling.count_words(docs_frame(spark, rows), misspell_every=every)
        assert dict(map(tuple, got.collect())) == plain_counts(rows, every)


def test_empty_tables(spark):
    assert groups(spark, {}) == []
    assert spelling.spelling_groups(spelling.count_words(docs_frame(spark, []))).collect() == []
    frame = spark.createDataFrame([(None, 5), ("lonely", 5)], "word string, n long")
    assert list(map(tuple, spelling.spelling_groups(frame).collect())) == [("lonely", None, "lonely", 5, 0, None)]
