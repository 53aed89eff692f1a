"""Spelling variant grouping: words one edit apart, found by bit-sliced position indexes over the vocabulary.

1. Words are counted with partial aggregates; the vocabulary (one row per word) is written.
2. Two words one edit apart share their first or last half: the lesser length L splits at the edit into common parts
   of together at least L - 1 letters, so one has at least L // 2. Words are dealt by (L, side, half); a bucket that
   outgrows a block is cut into pairs of blocks.
3. Within a group, one bitset over the group's words for each (position, letter). All queries of a length run through
   their letters together: ``zero`` holds the words equal so far, ``swapped`` those with one letter replaced,
   ``longer`` those with one letter more, whose positions are shifted by one. A letter costs a few word-parallel
   operations whatever the number of words. A letter missing is the same pair seen from the longer word.
4. A word's form is its most frequent near word; roots follow the forms by pointer doubling.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.blocks import block_pairs
from tidemart.llm.common import Scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["count_words", "spelling_groups", "near_pairs"]

#: Letters of a word: Latin-1, so a letter is one byte in the index.
LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK_ROWS = 20_000  # most words of a bucket that meet in one group, and entries of small buckets handled together
CHUNK_BYTES = 1 << 22  # letters of an index chunk; bounds memory for very long words
INDEX_WORDS, QUERY_WORDS = 4096, 1024


def _lower(run: Column) -> Column:
    """Lower-cases A to Z only. ``lower`` does that on plain ASCII, where it is fast."""
    return F.when(F.octet_length(run) == F.length(run), F.lower(run)).otherwise(
        F.translate(run, UPPER, LOWER))


def count_words(docs: DataFrame, min_length: int = 5, min_count: int = 3, misspell_every: int | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: lower-cased letter runs of the whole texts with at least ``min_length`` letters and ``min_count``
    occurrences.

    ``misspell_every`` plants spelling errors: with h the CRC-32 of ``<id>:<run>``, a run whose h it divides loses its
    letter number h modulo its length. Null texts have no words, a null id counts as an empty one, repeated rows count
    each time.
    """
    runs = docs.select(F.col(id_col).cast("string").alias("id"),
                       F.explode(F.regexp_extract_all(F.col(text_col), F.lit(LETTERS), F.lit(0))).alias("run"))
    runs = runs.where(F.length("run") >= min_length).select("id", _lower(F.col("run")).alias("run"))
    if misspell_every:
        h = F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
        cut = (F.col("h") % F.length("run")).cast("int")
        shorter = F.concat(F.substring(F.col("run"), F.lit(1), cut), F.substring(F.col("run"), cut + 2, F.length("run")))
        runs = runs.withColumn("h", h).select(
            F.when(F.col("h") % misspell_every == 0, shorter).otherwise(F.col("run")).alias("run"))
        runs = runs.where(F.length("run") >= min_length)
    return runs.groupBy(F.col("run").alias("word")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _letters(words: list[bytes], width: int) -> np.ndarray:
    """Letters as a byte matrix, padded with 0."""
    return np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)


class _Index:
    """Bitsets over the words of a chunk for each (position, letter); one position at a time is built and kept."""

    def __init__(self, words: np.ndarray):
        self.words, self.n = words, -(-len(words) // 64)
        self._kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def pack(self, member: np.ndarray) -> np.ndarray:
        """Rows of booleans over the words as rows of 64-bit words."""
        bits = np.packbits(member, axis=-1, bitorder="little")
        out = np.zeros((*bits.shape[:-1], self.n * 8), np.uint8)
        out[..., :bits.shape[-1]] = bits
        return out.view(np.uint64)

    def at(self, position: int) -> tuple[np.ndarray, np.ndarray]:
        """``(row of each letter, bitsets)``; the last row is empty, for letters no word has there."""
        if position not in self._kept:
            for old in [p for p in self._kept if p < position - 1]:
                del self._kept[old]
            letters, inverse = np.unique(self.words[:, position], return_inverse=True)
            rows = np.full(256, len(letters), np.int64)
            rows[letters] = np.arange(len(letters))
            self._kept[position] = rows, self.pack(np.arange(len(letters) + 1)[:, None] == inverse[None, :])
        return self._kept[position]

    def has(self, position: int, letters: np.ndarray) -> np.ndarray:
        rows, bitsets = self.at(position)
        return bitsets[rows[letters]]


def _pairs_of(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    q, w = np.nonzero(bits)
    k, b = np.nonzero(np.unpackbits(bits[q, w].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return q[k], w[k] * 64 + b


def near_pairs(queries: list[bytes], words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers ``(query, word)`` of all pairs one edit apart. All queries have one length; the words have that length
    (a letter replaced) or one letter more (a letter inserted)."""
    length = len(queries[0])
    step = max(1, min(INDEX_WORDS, CHUNK_BYTES // (length + 1)))
    for start in range(0, len(words), step):
        index = _Index(_letters(words[start:start + step], length + 1))
        sizes = np.array([len(w) for w in words[start:start + step]])
        equal, more = index.pack(sizes == length), index.pack(sizes == length + 1)
        lot = max(1, min(QUERY_WORDS, CHUNK_BYTES // length))
        for first in range(0, len(queries), lot):
            asked = _letters(queries[first:first + lot], length)
            zero = np.full((len(asked), index.n), ~np.uint64(0))
            longer, swapped = zero.copy(), np.zeros_like(zero)
            index._kept.clear()
            for i in range(length):
                here, after = index.has(i, asked[:, i]), index.has(i + 1, asked[:, i])
                swapped &= here
                swapped |= zero & ~here
                zero &= here
                longer &= after
                longer |= zero
            for bits in (swapped & equal, longer & more):
                q, w = _pairs_of(bits)
                if len(q):
                    yield q + first, w + start


def _group_forms(frame: pd.DataFrame) -> pd.DataFrame:
    """Near words found in one group: ``word, n_near, best, best_n`` with the most frequent (ties: least) near word."""
    words, n = [w.encode("latin-1") for w in frame["word"]], frame["n"].to_numpy(np.int64)
    size = frame["size"].to_numpy()
    side, asks, blk = frame["side"].to_numpy(), frame["asks"].to_numpy(bool), frame["blk"].to_numpy()
    apart = frame["bi"].iat[0] != frame["bj"].iat[0]  # a pair of blocks: pairs of one block are found elsewhere
    chars = np.array([len(w) for w in words])
    order = np.array(sorted(range(len(words)), key=lambda i: (-n[i], words[i])), np.int64)
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    count, best = np.zeros(len(words), np.int64), np.full(len(words), len(words), np.int64)
    for length, on in set(zip(size.tolist(), side.tolist(), strict=True)):
        there = np.flatnonzero((size == length) & (side == on))
        asked = there[asks[there]]
        if not len(asked):
            continue
        heads: dict[bytes, int] = {}
        head = np.zeros(len(words), np.int64)
        head[there] = [heads.setdefault(words[i][:length // 2], len(heads)) for i in there]
        for q, w in near_pairs([words[i] for i in asked], [words[i] for i in there]):
            a, b = asked[q], there[w]
            use = (head[a] == head[b]) == (on == 0)  # a pair that shares both halves counts once
            use &= (chars[b] > length) | (a < b)  # replaced letters are seen from both ends
            if apart:
                use &= blk[a] != blk[b]
            a, b = a[use], b[use]
            for x, y in ((a, b), (b, a)):
                np.add.at(count, x, 1)
                np.minimum.at(best, x, rank[y])
    has = np.flatnonzero(count)
    top = order[best[has]]
    text = frame["word"].to_numpy()
    return pd.DataFrame({"word": text[has], "n_near": count[has], "best": text[top], "best_n": n[top]})


def _near_words(vocab: DataFrame, block_rows: int) -> DataFrame:
    """``word, n_near, best, best_n`` for every word of ``vocab`` that has a near word."""
    size = F.length("word")
    entries = vocab.select("word", "n", F.explode(F.array(
        *[F.struct((size - less).cast("int").alias("size"), F.lit(less == 0).alias("asks"), F.lit(side).alias("side"))
          for less in (0, 1) for side in (0, 1)])).alias("e")).select("word", "n", "e.*").where("size > 0")
    half = F.expr("size div 2")
    text = F.when(F.col("side") == 0, F.substring(F.col("word"), F.lit(1), half)).otherwise(
        F.substring(F.col("word"), size - half + 1, half))
    entries = entries.withColumn("half", F.xxhash64(text))
    keys = ["size", "side", "half"]
    groups = block_pairs(entries, keys, F.xxhash64("word"), block_rows)
    total = vocab.agg(F.count(F.lit(1)), F.sum(F.length("word"))).first()
    batches = max(1, 4 * max(total[0] // BLOCK_ROWS, (total[1] or 0) // (16 * CHUNK_BYTES)))
    group = F.xxhash64(*keys, "bi", "bj")
    groups = groups.withColumn("batch", F.when(F.col("blocks") > 1, group).otherwise(F.pmod(group, F.lit(batches))))
    return groups.groupBy("blocks", "batch").applyInPandas(
        _group_forms, "word string, n_near bigint, best string, best_n bigint")


def spelling_groups(vocab: DataFrame, least_ratio: int = 2, block_rows: int = BLOCK_ROWS,
                    scratch: Scratch | None = None) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: one row per row of ``vocab`` (``word, n``; words distinct, Latin-1 letters).

    Two words are near if they differ by exactly one inserted, deleted or replaced letter; ``n_near`` is the number of
    near words. ``form`` is the near word of largest n (ties: the smallest in code-point order) if that n is at least
    ``least_ratio`` times the word's own, else null, and ``form_n`` its n. ``root`` follows the forms to the last; a
    word without a form is its own root. Null words are left out, an empty vocabulary gives an empty result.

    Scale: a word goes to four buckets by half words; buckets of more than ``block_rows`` words are cut into pairs of
    blocks, small ones are handled together in batches. Groups return one row per word, never pairs. A form at least
    doubles n, so roots take about log2(log2(largest n)) rounds of pointer doubling, each one join of words with forms.
    """
    if least_ratio < 2:
        raise ValueError("least_ratio must be at least 2, so that following forms ends")
    scratch = scratch or Scratch(vocab.sparkSession, "spelling")
    vocab = scratch.table(vocab.select("word", "n").where("word is not null"), "vocabulary")
    first = F.min(F.struct((-F.col("best_n")).alias("order"), F.col("best").alias("word")))
    near = _near_words(vocab, block_rows).groupBy(F.col("word").alias("w")).agg(
        F.sum("n_near").alias("n_near"), first.alias("best"))
    joined = vocab.join(near, F.col("word") == F.col("w"), "left")
    has = -F.col("best.order") >= least_ratio * F.col("n")
    words = scratch.table(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(has, F.col("best.word")).alias("form"), F.when(has, -F.col("best.order")).alias("form_n")), "forms")
    ends = scratch.table(words.where("form is not null").select("word", F.col("form").alias("last")), "ends")
    while True:
        ahead = ends.select(F.col("word").alias("at"), F.col("last").alias("next"))
        moved = scratch.table(ends.join(ahead, F.col("last") == F.col("at"), "left").select(
            "word", F.coalesce("next", "last").alias("last"), F.col("next").isNotNull().alias("moved")), "ends")
        scratch.drop(ends)
        ends = moved
        if moved.where("moved").isEmpty():
            break
    roots = ends.select(F.col("word").alias("w"), "last")
    return words.join(roots, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("last", "word").alias("root"), "n", "n_near", "form_n")
