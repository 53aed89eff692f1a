"""Tokenizer (UDF1-UDF2): latin words by regex split; CJK runs by the best path through a word lattice.

The latin path is a built-in expression. The CJK path needs per-string
dictionary matching, done per Arrow batch in a pandas UDF. The source system
used a Chinese segmentation library whose dictionary is not available here;
the caller gives one. All dictionary words that occur in a run, overlapping
ones too, are edges of a lattice; the segmentation is the path that leaves
the fewest characters outside words, then has the fewest words, then the
longer word first. Characters outside words are words of their own.
"""

from __future__ import annotations

import sys

import re

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions._col import as_col

# Python workers run this module's UDF/processor code: ship it by value so that executors
# need no installed copy of the package (they may not have it on their path).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["tokenize", "tokenize_cjk", "register_split_words"]


def tokenize(text, pattern: str = r"[^\p{L}\p{N}]+") -> Column:
    """Lower-case, split on ``pattern``, drop empty tokens (JVM-side, inside whole-stage codegen:
    ``array_remove`` rather than a lambda ``filter``)."""
    return F.array_remove(F.split(F.lower(as_col(text)), pattern), "")


# fixed values: the CJK ideograph blocks (extension A, unified, compatibility, supplementary)
_CJK = "㐀-䶿一-鿿豈-﫿\U00020000-\U000323af"
_RUN = re.compile(f"[{_CJK}]+|[^\\W_{_CJK}]+")
_IS_CJK = re.compile(f"[{_CJK}]")


_END = ""  # marks the end of a word in the trie


def _trie(words) -> dict:
    """Words as nested dicts by character."""
    root: dict = {}
    for w in words:
        node = root
        for c in w:
            node = node.setdefault(c, {})
        if w:
            node[_END] = node
    return root


def _best_path(run: str, trie: dict) -> list[str]:
    """Words of the best path: fewest characters outside dictionary words, then fewest words, then longest first."""
    n = len(run)
    cost, step = [(0, 0)] * (n + 1), [0] * n  # from each place to the end: (outside, words) and the word's length
    for i in range(n - 1, -1, -1):
        outside, count = cost[i + 1]
        cost[i], step[i] = (outside + 1, count + 1), 1  # a character on its own
        node = trie
        for j in range(i, n):
            node = node.get(run[j])
            if node is None:
                break
            if _END in node:
                found = (cost[j + 1][0], cost[j + 1][1] + 1)
                if found <= cost[i]:
                    cost[i], step[i] = found, j + 1 - i
    out, i = [], 0
    while i < n:
        out.append(run[i:i + step[i]])
        i += step[i]
    return out


def _segment(text: str, words, longest: int | None = None) -> list[str]:
    """Tokens of a text by a trie or by plain words (with ``longest``: those of at most so many characters)."""
    trie = words if isinstance(words, dict) else _trie(w for w in words if longest is None or len(w) <= longest)
    out: list[str] = []
    for m in _RUN.finditer(text.lower()):
        run = m.group(0)
        out += _best_path(run, trie) if _IS_CJK.match(run) else [run]
    return out


def tokenize_cjk(text, dictionary: list[str] | None = None) -> Column:
    """Tokens of mixed CJK/latin text: best path through the dictionary's words on CJK runs (pandas UDF)."""
    trie = _trie(w.lower() for w in dictionary or [])

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def _seg(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else _segment(x, trie))

    return _seg(as_col(text))


def register_split_words(spark, name: str = "split_words", dictionary: list[str] | None = None):
    """UDF1 for SQL: a table function ``split_words(text)`` -> rows of ``word`` (use with LATERAL).

    Splits like :func:`tokenize_cjk`: CJK runs by the best path, all other scripts at non-letters.
    """
    from pyspark.sql.functions import udtf

    trie = _trie(w.lower() for w in dictionary or [])

    @udtf(returnType="word: string")
    class SplitWords:
        def eval(self, text: str):
            for w in _segment(text or "", trie):
                yield (w,)

    spark.udtf.register(name, SplitWords)
    return SplitWords
