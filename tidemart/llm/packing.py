"""Best-fit packing of token sequences with certified lower bounds.

1. Texts are tokenized once; a document is its ids and an end id. Longer documents are cut into full pieces with the
   shorter piece first.
2. The pieces are dealt at random over partitions; each partition packs its pieces by best-fit decreasing.
3. Dual feasible functions give a lower bound on the bins of a partition. Where the bound is met, the partition is
   certified: no packing of its pieces is better.
4. Partitions with a gap give up the bins that are not full enough; the pieces of those bins are exchanged (pooled
   over fewer partitions) and packed again, for a few rounds or until no partition has a gap.
"""

from __future__ import annotations

import bisect
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import Scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["tokenize_pieces", "pack_pieces", "best_fit_decreasing", "lower_bound"]

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PACKED = PIECES + ", sequence_id bigint, offset bigint, certified boolean"
MOST_PER_PARTITION = 1 << 20  # a sequence id is (round, partition, bin) in one number


#: Fixed value: how byte-level BPE vocabularies of this family split a text before merging, written without backtracking.
SPLIT = r"'(?:[stmd]|re|ve|ll)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


def _byte_of() -> dict[str, int]:
    """Byte of each character that byte-level vocabularies write it as: printable bytes as themselves, all others in
    order from code point 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def load_encoder(tokenizer_file: str):
    """``encode(text) -> ids`` (array) for a tokenizers file: the ids of ``Tokenizer.encode(add_special_tokens=False)``.

    A plain byte-level BPE whose ids follow its merges is run by tiktoken over the file's own vocabulary, which is
    several times faster; any other file by tokenizers itself.
    """
    import json

    from tokenizers import Tokenizer

    with open(tokenizer_file, encoding="utf-8") as f:
        spec = json.load(f)
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
    byte, vocab = _byte_of(), model.get("vocab") or {}
    plain = (model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
             and pre.get("use_regex", True) and not spec.get("normalizer") and not model.get("dropout")
             and not model.get("ignore_merges") and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word")
                                                            for t in spec.get("added_tokens") or []))
    if plain:
        merged = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        plain = all(vocab.get(m.replace(" ", "")) == 256 + k for k, m in enumerate(merged))
    if not plain:
        tokenizer = Tokenizer.from_file(tokenizer_file)
        return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
    import tiktoken

    ranks = {bytes(byte[c] for c in w): i for w, i in vocab.items() if w not in special}
    encoding = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: encoding.encode_to_numpy(text, allowed_special="all")


def tokenize_pieces(docs: DataFrame, tokenizer_file: str, capacity: int = 2048, end_id: int = 0,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every document: ``doc_id, piece, start, length, ids_crc32`` (one pass over the texts, no shuffle).

    ``tokenizer_file`` is a path every executor can read. The pieces of a document after the first are full.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = load_encoder(tokenizer_file)
        end = np.array([end_id], "<u4").tobytes()
        for frame in frames:
            rows = []
            for doc_id, text in zip(frame["doc_id"].array, frame["text"].array, strict=True):
                ids = encode(text or "").astype("<u4").tobytes() + end
                n = len(ids) // 4
                cuts = [0, *range((n - 1) % capacity + 1, n + 1, capacity)] if n > capacity else [0, n]
                for k in range(len(cuts) - 1):
                    a, b = cuts[k], cuts[k + 1]
                    rows.append((doc_id, k, a, b - a, zlib.crc32(ids[4 * a:4 * b])))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            out["doc_id"] = pd.array(out["doc_id"].where(out["doc_id"].notna(), pd.NA), dtype="Int64")
            yield out

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(
        run, PIECES)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Least number of bins that any packing needs, from dual feasible functions (integer arithmetic, exact).

    The identity (total length), the rounding functions ``u_k`` for k = 1..20 (a length x counts as
    ``floor((k+1) x / C) / k``, or ``x / C`` where ``(k+1) x / C`` is whole), and the threshold functions for
    t up to C/2 (above C-t counts as a whole bin, below t as nothing, else as its length).
    """
    if len(lengths) == 0:
        return 0
    sizes, count = np.unique(np.asarray(lengths, np.int64), return_counts=True)
    total = int((sizes * count).sum())
    best = -(-total // capacity)
    for k in range(1, 21):
        q, r = np.divmod((k + 1) * sizes, capacity)
        scaled = np.where(r == 0, k * sizes, q * capacity)  # in units of 1 / (k C)
        best = max(best, -(-int((scaled * count).sum()) // (k * capacity)))
    mass, number = np.concatenate([[0], np.cumsum(sizes * count)]), np.concatenate([[0], np.cumsum(count)])
    t = np.unique(np.concatenate([sizes, capacity - sizes]))
    t = t[(t > 0) & (2 * t <= capacity)]
    lo, hi = np.searchsorted(sizes, t, "left"), np.searchsorted(sizes, capacity - t, "right")
    if len(t):
        best = max(best, int((number[-1] - number[hi] - (-(mass[hi] - mass[lo]) // capacity)).max()))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """``(bin, offset, number of bins)``: longest first, each into the fullest bin that still has room."""
    n = len(lengths)
    where, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    free: dict[int, list[int]] = {}  # open bins by their room
    rooms: list[int] = []  # sorted rooms that some bin has
    bins = 0
    for i in np.argsort(-np.asarray(lengths), kind="stable").tolist():
        size = int(lengths[i])
        at = bisect.bisect_left(rooms, size)
        if at == len(rooms):
            b, room = bins, capacity
            bins += 1
        else:
            room = rooms[at]
            b = free[room].pop()
            if not free[room]:
                del free[room], rooms[at]
        where[i], offset[i] = b, capacity - room
        if room > size:
            if room - size not in free:
                free[room - size] = []
                bisect.insort(rooms, room - size)
            free[room - size].append(b)
    return where, offset, bins


def _pack_group(capacity: int, round_no: int, last: bool, full_enough: float):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        lengths = frame["length"].to_numpy(np.int64)
        where, offset, bins = best_fit_decreasing(lengths, capacity)
        certified = bins == lower_bound(lengths, capacity)
        used = np.bincount(where, lengths, bins)
        ids = pd.array((round_no << 58) + (int(key[0]) << 20) + np.arange(bins, dtype=np.int64), dtype="Int64")
        if not certified and not last:
            ids[used < full_enough * capacity] = pd.NA  # given up: their pieces go to the next round
        out = frame[["doc_id", "piece", "start", "length", "ids_crc32"]].copy()
        out["sequence_id"], out["offset"], out["certified"] = ids[where], offset, certified
        return out
    return run


def pack_pieces(pieces: DataFrame, capacity: int = 2048, per_partition: int = 20_000, rounds: int = 3,
                full_enough: float = 0.999, scratch: Scratch | None = None) -> DataFrame:
    """Pieces plus ``sequence_id`` (64-bit), ``offset`` (gapless from 0) and ``certified``.

    ``certified`` says that the partition that packed the piece met its lower bound. ``per_partition`` is the number
    of pieces packed together: partitions grow in number with the input, never in size. Pieces are dealt by a random
    hash, so repeated ids or one large document do not gather in a partition. Each round is written to the shared
    folder; a piece keeps its bin unless that bin was given up.
    """
    if not 0 < per_partition <= MOST_PER_PARTITION // 4:
        raise ValueError("per_partition must be from 1 to 262,144")
    scratch = scratch or Scratch(pieces.sparkSession, "packing")
    todo, done = scratch.table(pieces, "pieces"), []
    for r in range(rounds):
        n = todo.count()
        parts = max(1, -(-n // per_partition))
        if n == 0 and done:
            break
        last = r == rounds - 1 or parts == 1 and r > 0
        dealt = todo.withColumn("part", F.pmod(F.xxhash64(F.lit(r), *todo.columns[:5], F.monotonically_increasing_id()),
                                               F.lit(parts)))
        packed = scratch.table(dealt.groupBy("part").applyInPandas(
            _pack_group(capacity, r, last, full_enough), PACKED), f"round{r}")
        done.append(packed.where("sequence_id is not null"))
        todo = packed.where("sequence_id is null").drop("sequence_id", "offset", "certified")
        if last:
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out
