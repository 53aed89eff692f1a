"""Substring dedup by difference-cover anchors.

A difference cover D modulo a period P has, for any two numbers a and b, a shift d < P with both a + d and b + d in D
(modulo P). If two places start the same L words, some shift d < P therefore gives an anchor, a short window of
L - P + 1 words, at a cover position in both. So it is enough to hash the short windows at the |D| of P cover
positions. Around every anchor that occurs twice, the L-word windows that contain it are then hashed in full (the
extension to both sides), and a window is repeated if its hash occurs elsewhere.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["substring_dedup", "DIFFERENCE_COVERS", "word_hashes", "window_hashes"]

#: Perfect difference sets (every nonzero difference modulo the period occurs exactly once).
DIFFERENCE_COVERS = {7: (1, 2, 4), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14), 31: (1, 5, 11, 24, 25, 27)}

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SLICE = 1 << 20  # bytes hashed at once
_BASE = 0x9E3779B97F4A7C15
_ODD = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD[0]
    return (x ^ (x >> np.uint64(29))) * _ODD[1]


def _powers() -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(_SLICE + 1, np.uint64(base), np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


def word_hashes(data: bytes, powers: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hashes, starts, ends)`` of the words of UTF-8 bytes, whole arrays at a time."""
    hashes, starts, ends, at = [], [], [], 0
    while at < len(data):
        stop = min(at + _SLICE, len(data))
        a = np.frombuffer(data, np.uint8, stop - at, at)
        space = _SPACE[a]
        if stop < len(data):
            gaps = np.flatnonzero(space)
            if len(gaps):  # end the slice behind its last white space
                stop = at + int(gaps[-1]) + 1
                a, space = a[:stop - at], space[:stop - at]
            else:  # one word longer than a slice
                rest = np.flatnonzero(_SPACE[np.frombuffer(data, np.uint8, len(data) - stop, stop)])
                stop = stop + int(rest[0]) if len(rest) else len(data)
                digest = hashlib.sha256(data[at:stop]).digest()
                hashes.append(np.frombuffer(digest[:8], "<u8").astype(np.uint64))
                starts.append(np.array([at]))
                ends.append(np.array([stop]))
                at = stop
                continue
        edge = np.flatnonzero(np.diff(space.astype(np.int8), prepend=1, append=1))
        s, e = edge[0::2], edge[1::2]
        total = np.zeros(len(a) + 1, np.uint64)
        np.cumsum((a.astype(np.uint64) + np.uint64(1)) * powers[0][:len(a)], out=total[1:])
        h = (total[e] - total[s]) * powers[1][s]
        hashes.append(_mix(h + (e - s).astype(np.uint64) * _ODD[2]))
        starts.append(s + at)
        ends.append(e + at)
        at = stop
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts), np.concatenate(ends)


def window_hashes(words: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hash of every window of ``length`` words, put together from windows of 1, 2, 4, ... words."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, size, done, out = words ^ np.uint64(seed), 1, 0, None
    while True:
        if length & size:
            piece = power[done:done + n]
            out = piece if out is None else _mix(out * _ODD[3] + piece)
            done += size
        if done == length:
            return out
        power = _mix(power[:len(power) - size] * _ODD[2] + power[size:])
        size *= 2


class _Chunk:
    """Words of several documents in one array, with their document and their place in it."""

    def __init__(self, texts: list[bytes], powers):
        hashes = [word_hashes(t, powers)[0] for t in texts] if any(len(t) > _SLICE for t in texts) else None
        if hashes is None:
            joined = b"\n".join(texts)
            lengths = np.array([len(t) + 1 for t in texts], np.int64)
            bounds = np.concatenate([[0], np.cumsum(lengths)])
            self.words, starts, _ = word_hashes(joined, powers)
            self.first = np.searchsorted(starts, bounds)
        else:
            self.words = np.concatenate(hashes)
            self.first = np.concatenate([[0], np.cumsum([len(h) for h in hashes])])
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.place = np.arange(len(self.words)) - self.first[self.doc]

    def fits(self, length: int) -> np.ndarray:
        """For every place, whether a window of ``length`` words from it stays in its document."""
        return self.place + length <= np.diff(self.first)[self.doc]


def _chunks(frame: pd.DataFrame, powers) -> Iterator[tuple[int, _Chunk]]:
    """Chunks of about a slice of text: (first row of the frame, chunk)."""
    texts, size, at = [], 0, 0
    for i, t in enumerate(frame["text"]):
        texts.append((t or "").encode("utf-8", "surrogatepass"))
        size += len(texts[-1]) + 1
        if size >= _SLICE // 2:
            yield at, _Chunk(texts, powers)
            texts, size, at = [], 0, i + 1
    if texts:
        yield at, _Chunk(texts, powers)


def _first_and_repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every key, whether it is the first of its value, and whether its value occurs again. The rows stay in the
    order of documents, where their shared columns compress well."""
    order = np.argsort(keys, kind="stable")
    new = np.concatenate([[True], keys[order][1:] != keys[order][:-1]])
    head, repeated = np.empty(len(keys), bool), np.empty(len(keys), bool)
    head[order], repeated[order] = new, ~new | np.concatenate([~new[1:], [False]])
    return head, repeated


def _anchors(length: int, period: int):
    cover = np.zeros(period, bool)
    cover[list(DIFFERENCE_COVERS[period])] = True
    short = length - period + 1

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Per batch one row for each distinct anchor and, for the other findings of an anchor
        that the batch itself repeats, a row with a key of its own: they need no answer from other batches, and a
        very common anchor sends one row per batch. ``at`` is twice the place, plus 1 if the batch repeats the anchor."""
        powers = _powers()
        for frame in frames:
            rid = frame["rid"].to_numpy(np.int64)
            keys, rows, places = [], [], []
            for at, c in _chunks(frame, powers):
                h = window_hashes(c.words, short)
                # a document shorter than a window has no use for anchors
                size = np.diff(c.first)[c.doc[:len(h)]]
                ok = np.flatnonzero(cover[c.place[:len(h)] % period] & c.fits(short)[:len(h)] & (size >= length))
                keys.append(h[ok])
                rows.append(c.doc[ok] + at)
                places.append(c.place[ok])
            if not keys:
                continue
            g, row, place = np.concatenate(keys), np.concatenate(rows), np.concatenate(places)
            if not len(g):
                continue
            head, repeated = _first_and_repeated(g)
            own = _mix(rid[row].view(np.uint64) + place.astype(np.uint64) * _ODD[3])
            yield pd.DataFrame({"g": np.where(head, g, own).view(np.int64), "rid": rid[row],
                                "at": 2 * place + (repeated | ~head)})
    return run


def _candidates(anchors: np.ndarray, n_words: int, length: int, period: int) -> np.ndarray:
    """Starts of the windows that contain one of the anchors as their aligned one (as a mask)."""
    n = n_words - length + 1
    if n <= 0 or len(anchors) == 0:
        return np.zeros(max(n, 0), bool)
    step = np.zeros(n_words + 2, np.int64)
    np.add.at(step, np.maximum(anchors - period + 1, 0), 1)
    np.add.at(step, anchors + 1, -1)
    return np.cumsum(step)[:n] > 0


def _places(value) -> np.ndarray:
    return np.zeros(0, np.int64) if value is None else np.unique(np.asarray(value, np.int64))


def _windows(length: int, period: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = _powers()
        for frame in frames:
            rid = frame["rid"].to_numpy(np.int64)
            parts = []
            for at, c in _chunks(frame, powers):
                h, chk = window_hashes(c.words, length), window_hashes(c.words, length, seed=0x5851F42D4C957F2D)
                for d in range(len(c.first) - 1):
                    a, b = int(c.first[d]), int(c.first[d + 1])
                    s = np.flatnonzero(_candidates(_places(frame["anchors"].iloc[at + d]), b - a, length, period))
                    if len(s):
                        parts.append((h[a + s], chk[a + s], np.full(len(s), rid[at + d]), s))
            if not parts:
                continue
            g, chk, row, place = (np.concatenate(x) for x in zip(*parts, strict=True))
            head, repeated = _first_and_repeated(g ^ chk)
            yield pd.DataFrame({"g": g.view(np.int64)[head], "chk": (chk >> np.uint64(48)).astype(np.uint16).view(np.int16)[head],
                                "rid": row[head], "at": 2 * place[head] + repeated[head]})
    return run


def _kept(length: int, period: int, with_text: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for doc_id, text, anchors, single in zip(frame["doc_id"].array, frame["text"].array, frame["anchors"],
                                                     frame["single"], strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                starts = _candidates(_places(anchors), len(words), length, period)
                if len(starts):
                    starts[_places(single)] = False
                gone = np.zeros(len(words) + 1, np.int64)
                at = np.flatnonzero(starts)
                np.add.at(gone, at, 1)
                np.add.at(gone, at + length, -1)
                gone = np.cumsum(gone)[:len(words)] > 0
                left = b" ".join(w for w, x in zip(words, gone.tolist(), strict=True) if not x) if gone.any() else b" ".join(words)
                rows.append((doc_id, len(words), int(gone.sum()), hashlib.sha256(left).hexdigest(),
                             left.decode("utf-8", "surrogatepass") if with_text else None))
            out = pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])
            out["doc_id"] = pd.array(out["doc_id"].where(out["doc_id"].notna(), pd.NA), dtype="Int64")
            yield out if with_text else out.drop(columns="kept_text")
    return run


def substring_dedup(docs: DataFrame, length: int = 35, period: int = 21, id_col: str = "doc_id",
                    text_col: str = "text", with_text: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` (and ``kept_text``) per row of ``docs``.

    Removed is every word in a window of ``length`` words that starts the same words as any other place, in the same
    document or another one. Windows are judged on the input.

    Scale: shuffled are the anchors (5 of 21 places), the texts once, and the full windows near repeated anchors. A
    task answers findings that repeat within its own batch itself, so a passage that a third of all documents share
    sends one row per batch and not one per document. Only windows that turn out to be single are answered.

    Null and empty texts: 0 words. Null ids are allowed. Repeated rows repeat each other's windows, so all their
    words go (from ``length`` words on). Texts shorter than ``length`` words keep everything. Empty table: empty
    result; extra columns are ignored.
    """
    if not 0 < period < length or period not in DIFFERENCE_COVERS:
        raise ValueError(f"period must be one of {sorted(DIFFERENCE_COVERS)} and less than the length")
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    d = d.withColumn("rid", F.xxhash64("doc_id", "text"))
    found = d.select("rid", "text").mapInPandas(_anchors(length, period), "g bigint, rid bigint, at bigint")
    findings, place = F.sum(F.col("at") % 2 + 1), F.shiftright("at", 1).cast("int")
    shared = found.withColumn("total", findings.over(Window.partitionBy("g"))).where("total > 1")
    anchors = shared.groupBy("rid").agg(F.collect_set(place).alias("anchors")).withColumnRenamed("rid", "ar")
    marked = d.join(anchors, F.col("rid") == F.col("ar"), "left").drop("ar")
    windows = marked.where("anchors is not null").select("rid", "doc_id", "text", "anchors").mapInPandas(
        _windows(length, period), "g bigint, chk smallint, rid bigint, at bigint")
    lone = windows.withColumn("total", findings.over(Window.partitionBy("g", "chk"))).where("total = 1")
    single = lone.groupBy("rid").agg(F.collect_set(place).alias("single")).withColumnRenamed("rid", "sr")
    out = marked.join(single, F.col("rid") == F.col("sr"), "left").select("doc_id", "text", "anchors", "single")
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    return out.mapInPandas(_kept(length, period, with_text), schema + (", kept_text string" if with_text else ""))
