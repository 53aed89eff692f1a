"""Byte-level BPE: the library's own ids on whole texts, a plain merge loop, safe cuts, extreme texts."""

import random

import numpy as np
import pytest
import regex
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import docs_frame
from tidemart.llm import bpe

public = pytest.importorskip("public_tokenizers")
RANK_FILE, PATTERN = public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN
FEW = settings(max_examples=300, deadline=None, suppress_health_check=list(HealthCheck))
PIECES = ["a", "word", "Don't", "'ll", "'", "12", "!", "...", " ", "  ", "\n", "\n\n", "\t", "\x85", "\xa0", " ", "\x1c",
          "漢字", "。", "é", "א", "ٱ", "😀", "ß", "_", "Ⅷ", "²", "​", "'s", "é"]


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(RANK_FILE)


@pytest.fixture(scope="module")
def small():
    return bpe.TextEncoder(RANK_FILE, PATTERN, limit=5)


def plain_ids(text, ranks):
    """Brute force: split by the pattern, then merge the pair of least rank until none is left."""
    ids = []
    for match in regex.findall(PATTERN, text):
        parts = [bytes([b]) for b in match.encode()]
        while True:
            found = [(ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks]
            if not found:
                break
            _, i = min(found)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        ids += [ranks[p] for p in parts]
    return ids


@FEW
@given(st.lists(st.sampled_from(PIECES), max_size=40).map("".join))
def test_cuts_do_not_change_the_ids(small, text):
    assert "".join(s for s, _ in bpe.cut_long_text(text, 5)) == text
    assert small.encode(text).tolist() == small.split.encode_ordinary(text)
    assert small.decode(small.encode(text).tolist()) == text.encode()


def test_ids_equal_a_plain_merge_loop(ranks, small):
    rng = random.Random(5)
    for _ in range(200):
        text = "".join(rng.choice(PIECES[:23]) for _ in range(rng.randrange(30)))
        assert small.encode(text).tolist() == plain_ids(text, ranks), text


@pytest.mark.parametrize("blank", [" ", "\n", "\xa0", " \n\t"])
def test_long_blank_runs_are_one_match(small, blank):
    run = blank * 40_000
    for text in (run, run + "x", "x" + run, "a" + run + "b " + run + "1", run + "!"):
        assert small.encode(text).tolist() == small.split.encode_ordinary(text)


def test_runs_beyond_the_pattern_engine(small):
    """Three million blanks make the library fail on the whole text."""
    ids = small.encode("x" + " " * 3_000_000 + "y")
    assert small.decode(ids.tolist()) == b"x" + b" " * 3_000_000 + b"y"
    word = small.encode("z" * 1_000_000)
    assert small.decode(word.tolist()) == b"z" * 1_000_000


def test_table_with_edge_cases(spark):
    encoder = bpe.TextEncoder(RANK_FILE, PATTERN)
    long = "The quick brown fox, jumps!\n 漢字かな混じり文。" * 20_000
    rows = [(1, None), (2, ""), (3, "Hello <|endoftext|>"), (3, "Hello <|endoftext|>"), (None, "é́"), (5, long)]
    docs = docs_frame(spark, rows).withColumn("ids", F.lit("clash"))
    got = bpe.decode_ids(bpe.encode_texts(docs, RANK_FILE, PATTERN), RANK_FILE, PATTERN)
    assert got.columns == [*(c for c in docs.columns if c != "ids"), "ids", "decoded"]
    seen = sorted(((r["doc_id"], r["text"], r["ids"], bytes(r["decoded"]), r["size"]) for r in got.collect()), key=repr)
    want = [(i, t, encoder.split.encode_ordinary(t or ""), (t or "").encode(), 1) for i, t in rows]
    assert seen == sorted(want, key=repr)
    assert bpe.encode_texts(docs_frame(spark, []), RANK_FILE, PATTERN).collect() == []


def test_batches_are_cut_by_tokens(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(bpe, "FLUSH", 10)
    column = pa.array([3, 9, 1, 30, 2])
    parts = list(bpe._batches(column, lambda v: np.zeros(v.as_py()), len))
    assert [(a, n) for a, n, _ in parts] == [(0, 2), (2, 2), (4, 1)]


def test_lists_of_a_column():
    import pyarrow as pa

    column = pa.array([[1, 2], None, [], [3]], pa.list_(pa.int32()))
    assert list(bpe._lists(column)) == [[1, 2], [], [], [3]] and list(bpe._lists(column.slice(1, 3))) == [[], [], [3]]


def test_query_on_whole_table(spark):
    import hashlib

    from tidemart.llm.queries import op11_byte_bpe

    sf = "/root/testdata/sf0.001"
    encoder = bpe.TextEncoder(RANK_FILE, PATTERN)
    want = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = encoder.split.encode_ordinary(r["text"] or "")
        want.append((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert sorted(map(tuple, op11_byte_bpe(spark, sf).collect())) == sorted(want)
