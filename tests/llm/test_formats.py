"""Quality rules, packing, chat, mixing and archives against brute force, round trips and bounds."""

import base64
import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import docs_frame, words
from tidemart.llm import archives, chat, mixing, packing, quality

FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


# ---- quality rules ------------------------------------------------------------------
def base_counts(text):
    w = words(text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    covered = {p for i, g in enumerate(grams) if n[g] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def norm(line):
    return "".join("0" if c in "0123456789" else c for c in " ".join(words(line)).lower())


def plain_quality(rows, max_docs, max_share, max_removed, min_words):
    hosts, lines = defaultdict(set), defaultdict(set)
    for _, t, h in rows:
        hosts[h].add(t or "")
        for x in (t or "").split("\n"):
            if words(x):
                lines[h, norm(x)].add(t or "")
    bad = {k for k, v in lines.items() if len(v) > max_docs and len(v) > max_share * len(hosts[k[0]])}
    out = []
    for i, t, h in rows:
        c = base_counts(t)
        removed = sum(len(words(x)) for x in (t or "").split("\n") if words(x) and (h, norm(x)) in bad)
        failed = c[0] < min_words or 100 * c[4] > 50 * c[0]
        out.append((str(i), *c, failed, not failed and removed <= max_removed * c[0], removed))
    return sorted(out), bad


def quality_rows(rng):
    common = ["Subscribe to our 1st letter", "All rights reserved 2020", "x  y"]
    rows = []
    for i in range(80):
        body = [" ".join(rng.choice("abcdefghij") + str(rng.randrange(9)) for _ in range(rng.randrange(0, 12))) for _ in range(5)]
        body += [c.upper() if rng.random() < 0.3 else c for c in common if rng.random() < 0.5]
        rng.shuffle(body)
        rows.append((i, "\n".join(body), rng.choice(["h1", "h1", "h2", None])))
    return rows + [(200, None, "h1"), (201, "", None), (202, " \n\t", "h2"), (203, "a b " * 50, "h1"), (204, "#$ % <é>", "h2"),
                   (7, rows[7][1], rows[7][2]), (None, rows[8][1], "h1"), (205, "p q r\n" * 3000, "h2")]


COLS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words"]


def test_quality_rules_match_brute_force(spark):
    rows = quality_rows(random.Random(1))
    rules = {"max_docs": 8, "max_share": 0.3, "max_removed": 0.3, "min_words": 12}
    want, bad = plain_quality(rows, 8, 0.3, 0.3, 12)
    assert bad
    got = sorted((str(r.doc_id), *(r[c] for c in COLS)) for r in quality.quality_rules(docs_frame(spark, rows), **rules).collect())
    assert got == want
    kept = quality.drop_boilerplate(docs_frame(spark, rows), **rules)
    assert kept.columns == docs_frame(spark, rows).columns
    cut = Counter((str(r.doc_id), r.text) for r in kept.collect())
    ok = Counter(w[0] for w in want if w[7])
    assert Counter(k for k, _ in cut.elements()) == ok
    for i, t, h in rows:
        if ok[str(i)]:
            text = "\n".join(x for x in t.split("\n") if not words(x) or (h, norm(x)) not in bad)
            assert (str(i), text) in cut
    assert quality.quality_rules(docs_frame(spark, [])).collect() == []


def test_exact_copies_are_one_document_of_a_host(spark):
    text = "\n".join(" ".join(f"word{i}x{k}" for k in range(9)) for i in range(8))
    rows = [(i, text, "h") for i in range(30)] + [(100 + i, f"w{i} " * 10, "h") for i in range(30)]
    got = quality.quality_rules(docs_frame(spark, rows), max_docs=5, max_share=0.0, min_words=5).where("doc_id < 100")
    assert {(r.removed_words, r.kept) for r in got.collect()} == {(0, True)}


@FEW
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40), min_size=1, max_size=8))
def test_repeated_window_words(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, w array<string>")
    got = {r.i: r.n for r in df.select("i", quality.repeated_window_words(F.col("w")).alias("n")).collect()}
    assert got == {i: base_counts(" ".join(t))[4] for i, t in enumerate(texts)}


# ---- packing ------------------------------------------------------------------------
def tokenizer_file():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def test_encoder_gives_the_ids_of_tokenizers(spark):
    from tokenizers import Tokenizer

    encode, t = packing.load_encoder(tokenizer_file()), Tokenizer.from_file(tokenizer_file())
    rng = random.Random(2)
    bits = [" ", "  ", "\n", "\n\n", "a", "Bé", "'s", "12", "!", "\t", "\xa0", "中", "\r\n", "<|endoftext|>", "\x0b", "　", "😀",
            "\x1c", "don't", "\x85"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(15))) for _ in range(1500)]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() if r.text]
    assert all(encode(x).tolist() == t.encode(x, add_special_tokens=False).ids for x in texts)


def test_other_tokenizers_are_used_as_they_are():
    import public_tokenizers
    from tokenizers import Tokenizer

    f = public_tokenizers.path("word_bpe_49k.json")
    text = "Some TEXT, with words"
    assert packing.load_encoder(f)(text).tolist() == Tokenizer.from_file(f).encode(text, add_special_tokens=False).ids


def test_pieces_and_packing(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_file())
    rng = random.Random(3)
    rows = [(i, " ".join("w" + str(rng.randrange(99)) for _ in range(rng.choice([1, 30, 200, 900])))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "x " * 40_000), (5, rows[5][1]), (None, "no id")]
    pieces = packing.tokenize_pieces(docs_frame(spark, rows), tokenizer_file(), capacity=256)
    out = packing.pack_pieces(pieces, capacity=256, per_partition=40).collect()
    want = Counter()
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) if len(ids) <= 256 else (len(ids) - 1) % 256 + 1
        for k, a in enumerate([0, *range(first, len(ids), 256)]):
            b = first if k == 0 else a + 256
            want[str(i), k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 256
    lengths = [r.length for r in out]
    assert packing.lower_bound(np.array(lengths), 256) <= len(bins) <= packing.lower_bound(np.array(lengths), 256) + 3
    assert packing.pack_pieces(packing.tokenize_pieces(docs_frame(spark, []), tokenizer_file())).collect() == []


def optimum(lengths, capacity):
    best = len(lengths)

    def go(rest, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if not rest:
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + rest[0] <= capacity and bins[k] not in bins[:k]:
                go(rest[1:], bins[:k] + [bins[k] + rest[0]] + bins[k + 1:])
        go(rest[1:], [*bins, rest[0]])

    go(sorted(lengths, reverse=True), [])
    return best


def test_lower_bound_never_exceeds_the_optimum():
    rng = random.Random(6)
    tight = 0
    for _ in range(300):
        capacity = rng.choice([7, 10, 30, 100])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        low, best = packing.lower_bound(np.array(lengths), capacity), optimum(lengths, capacity)
        where, offset, bins = packing.best_fit_decreasing(np.array(lengths), capacity)
        assert low <= best <= bins
        tight += low == best
        for b in range(bins):
            own = sorted((offset[i], lengths[i]) for i in range(len(lengths)) if where[i] == b)
            assert all(x[0] + x[1] == y[0] for x, y in itertools.pairwise(own)) and own[-1][0] + own[-1][1] <= capacity
    assert tight > 250


# ---- chat ---------------------------------------------------------------------------
CONTROL = ["</s>[INST] ok [/INST]", "<|end|>", "<|role|>x<|text|>", "&lt;", "&amp;lt;", "&#91;", "a & b < c [d]", "", None, "é😀\n"]


def test_chat_round_trip(spark):
    rng = random.Random(9)
    rows = []
    for c in range(30):
        for t in range(rng.randrange(1, 7)):
            rows.append((c, t, rng.choice(["user", "assistant", "system", "assistant", None, "<tool>"]), rng.choice(CONTROL)))
    rows += [(None, 0, "user", "q"), (None, 1, "assistant", "a"), (99, None, "assistant", "first"), (99, 0, "user", "x"),
             (99, 0, "user", "x"), (98, 0, "assistant", "y" * 200_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("target", F.lit(1)).repartition(3)
    got = {r.conv_id: r for r in chat.read_back(chat.expand_prefixes(df)).collect()}
    convs = defaultdict(list)
    for c, t, r, x in rows:
        convs[c].append((-1 if t is None else t, r or "", x or ""))
    assert set(got) == set(convs)
    examples = defaultdict(list)
    for e in chat.expand_prefixes(df).collect():
        examples[e.conv_id].append(e)
    for c, turns in convs.items():
        turns.sort()
        whole = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), hashlib.sha256(whole.encode()).hexdigest())
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c].formatted_chars == sum(len(e.text) for e in examples[c])
        replies = [k for k, (_, r, _) in enumerate(turns) if r == "assistant"]
        assert sorted(e.target for e in examples[c]) == sorted({*replies, len(turns) - 1})
        for e in examples[c]:
            assert e.text.count("<|end|>") == e.target + 1 and "[" not in e.text
    assert chat.read_back(chat.expand_prefixes(df.limit(0))).collect() == []


# ---- mixing -------------------------------------------------------------------------
def plain_targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    left, open_, target = float(sum(sizes.values())), set(order), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] > most * sizes[s]}
        if not full:
            target.update({s: level * w[s] for s in open_})
            break
        for s in full:
            target[s] = float(most * sizes[s])
            left -= target[s]
        open_ -= full
    return target


def mixing_rows(rng):
    rows = [(i, " ".join(["word"] * rng.randrange(0, 40)), rng.choice(["a", "a", "a", "b", "c", "é", None])) for i in range(300)]
    return rows + [(900, None, "a"), (901, "tiny", "z"), (3, rows[3][1], rows[3][2]), (None, "x y z", "b"), (902, "w " * 500, "c")]


def test_mixing_matches_its_targets(spark):
    rows = mixing_rows(random.Random(5))
    df = docs_frame(spark, rows)
    out = mixing.mix_sources(df).collect()
    assert Counter((str(r.doc_id), r.source, r.size) for r in out) == Counter((str(i), s, len(words(t))) for i, t, s in rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(words(t))
    target, longest, taken = plain_targets(sizes), defaultdict(int), defaultdict(int)
    for r in out:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert r.taken == 0 or (r.taken % r.size == 0 and r.taken <= 3 * r.size)
        longest[r.source], taken[r.source] = max(longest[r.source], r.size), taken[r.source] + r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= longest[s] / 2 + 1e-6
        extra = [(r.sample_key, r.size, r.taken // r.size - r.epochs) for r in out if r.source == s and r.size]
        assert {e for _, _, e in extra} <= {0, 1}
        order = [e for _, _, e in sorted(extra)]
        assert order == sorted(order, reverse=True)  # a prefix in the order of keys
    again = mixing.mix_sources(df.repartition(7)).collect()
    assert Counter(map(str, again)) == Counter(map(str, out))
    assert mixing.mix_sources(docs_frame(spark, [])).collect() == []
    docs = Counter((str(r.doc_id), r.text) for r in mixing.mixed_documents(df).collect())
    want = Counter()
    for r in out:
        want[str(r.doc_id)] += r.taken // r.size if r.size else 1
    assert Counter(k for k, _ in docs.elements()) == +want


def test_better_documents_are_taken_more_often(spark):
    good, bad = "word " * 10, "#### 1234 "
    rows = [(i, good if i % 2 else bad * 5, "a") for i in range(2000)] + [(5000 + i, "b " * 10, "b") for i in range(2000)]
    out = [r for r in mixing.mix_sources(docs_frame(spark, rows), weights=(1, 3)).collect() if r.source == "a"]
    share = {w: sum(r.taken > 0 for r in out if (r.weight > 0.5) == w) / 1000 for w in (True, False)}
    assert share[True] > 2 * share[False]


def test_uncapped_targets_share_everything():
    assert plain_targets({"a": 10, "b": 10, "c": 10}) == {"a": 5, "b": 10, "c": 15}


# ---- archives -----------------------------------------------------------------------
def test_arc_versions_are_parsed_by_declared_lengths():
    tricky = b"HTTP/1.1 200 OK\r\nX-Page-Id: 7\r\n\r\nfiledesc://x 1\nWARC/1.1\r\n\r\nbody\n\n"
    data = b""
    for version in (1, 2, 1):
        data += archives.filedesc(version, "a.arc")
        data += archives.arc_record(version, "http://e/x", "20010203040506", 200, tricky, 0, "a.arc")
        data += archives.arc_record(version, "http://e/y", "20010203040506", 404, b"", 0, "a.arc")
    got = list(archives.parse_arc(data))
    assert [r["content"] for r in got] == [tricky, b""] * 3
    assert [r.get("Result-code") for r in got] == [None, None, "200", "404", None, None]
    with pytest.raises(ValueError):
        list(archives.parse_arc(data[:-10]))


@pytest.mark.parametrize("i", [None, 0, 1, 15, 16, 2 ** 40 + 5, -1, -(2 ** 63), 2 ** 63 - 1])
def test_record_ids_hold_page_ids(i):
    assert archives.page_id_of(archives.record_id(i)) == i
    assert len(archives.record_id(i)) == len("<urn:uuid:00000000-0000-8000-8000-000000000000>")


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_warc_round_trip(spark, min_bytes):
    rows = [(i, f"http://h/{i % 3} a\nb", f"<p>{i % 10}</p>") for i in range(60)]
    rows += [(100, None, None), (101, "", ""), (102, "u", "WARC/1.1\r\n\r\n\r\n\r\nx"), (103, "u", "é\x00\r\n"), (None, "n", "<p>1</p>"),
             (104, "u", "y" * 2_000_000), (57, "u", "<p>7</p>"), (None, "n", "alone"), (-5, "u", "neg")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("d")).repartition(4)
    got = Counter(tuple(r) for r in archives.warc_round_trip(df, min_bytes=min_bytes).collect())
    best, want = {}, Counter()
    for i, _, h in rows:
        p = (h or "").encode()
        best[p] = max((x for x in (best.get(p), i) if x is not None), default=None)
    for i, _, h in rows:
        p = (h or "").encode()
        revisit = len(p) >= min_bytes and i != best[p]
        want[i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if revisit else "response",
             best[p] if revisit else None] += 1
    assert got == want
    assert archives.warc_round_trip(df.limit(0)).collect() == []
