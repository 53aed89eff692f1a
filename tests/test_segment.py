"""Segmentation by the best path: against brute force over all paths, crossing words, mixed scripts."""

from hypothesis import given, settings
from hypothesis import strategies as st

from tidemart.functions.tokenize import _best_path, _segment, _trie, tokenize_cjk

LETTERS = "天地人和"


def all_paths(run):
    if not run:
        yield []
    for n in range(1, len(run) + 1):
        for rest in all_paths(run[n:]):
            yield [run[:n], *rest]


def plain(run, words):
    """The path of least (characters outside words, number of words, minus the lengths in order)."""
    paths = (p for p in all_paths(run) if all(len(w) == 1 or w in words for w in p))
    return min(paths, key=lambda p: (sum(w not in words for w in p), len(p), [-len(w) for w in p]))


@settings(max_examples=400, deadline=None)
@given(st.text(LETTERS, min_size=1, max_size=9), st.sets(st.text(LETTERS, min_size=1, max_size=4), max_size=8))
def test_best_path_equals_brute_force(run, words):
    got = _best_path(run, _trie(words))
    assert got == plain(run, words) and "".join(got) == run


def test_crossing_words():
    """Longest match from the left takes the crossing word and leaves a single character behind."""
    words = ["小米", "手机", "小米手", "研究", "研究生", "生命", "起源"]
    assert _best_path("小米手机", _trie(words)) == ["小米", "手机"]
    assert _best_path("研究生命起源", _trie(words)) == ["研究", "生命", "起源"]
    assert _best_path("研究生", _trie(words)) == ["研究生"]


def test_mixed_text(spark):
    df = spark.createDataFrame([("Buy 小米手机 X1, 好", 1), (None, 2), ("", 3)], "t string, i int")
    got = {r.i: r.w for r in df.select("i", tokenize_cjk("t", ["小米", "手机", "小米手"]).alias("w")).collect()}
    assert got == {1: ["buy", "小米", "手机", "x1", "好"], 2: None, 3: []}
    assert _segment("天" * 5000, _trie(["天天天"]))[:2] == ["天天天", "天天天"]
