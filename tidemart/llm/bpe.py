"""Byte-level BPE by the tiktoken library: texts to ids and ids back to bytes, from a local rank file.

Every match of the split pattern is merged on its own, so a text may be cut wherever a match is sure to end:

* before a blank or line break that follows anything but white space, since no match holds white space after
  another character;
* before punctuation (no apostrophe) that follows a letter or digit, since no match holds such a pair.

Long texts are cut there. A long run of white space, which the library's pattern engine cannot take (its look-ahead
keeps one state per character), is handed over as the one match it is. Ids are decoded to raw bytes, because an id may
end inside a character.
"""

from __future__ import annotations

import base64
import re
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["read_ranks", "TextEncoder", "encode_texts", "decode_ids", "cut_long_text"]

#: The characters with the White_Space property.
WHITE = "\t-\r \x85\xa0  -     　"
#: Letters and digits of common scripts, and marks that are neither letter, digit, space nor apostrophe: enough to
#: find a cut in any ordinary text, and classed alike by every Unicode version.
WORD_END = "0-9A-Za-z\xc0-\xd6\xd8-\xf6А-яぁ-ゖァ-ヺ一-龥가-힣"
MARKS = "!-&(-/:-@\\[-`{-~、。！，？"
CUT = re.compile(f"(?<=[^{WHITE}])(?=[ \n\r\t])|(?<=[{WORD_END}])(?=[{MARKS}])")
LONG_BLANK = 1000
LONG_BLANKS = re.compile(f"[{WHITE}]{{{LONG_BLANK},}}")
SEGMENT_CHARS = 1 << 16
FLUSH = 1 << 22  # ids or bytes in one Arrow batch that goes back to Spark


def read_ranks(rank_file: str) -> dict[bytes, int]:
    """Token bytes to id of a rank file (lines of base64 text and number)."""
    with open(rank_file, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def cut_long_text(text: str, limit: int = SEGMENT_CHARS) -> Iterator[tuple[str, bool]]:
    """``(segment, is one match)`` in order. Segments have about ``limit`` characters; only a run without any safe
    boundary is longer."""
    if len(text) <= min(limit, LONG_BLANK):
        if text:
            yield text, False
        return
    at = 0
    for run in [*LONG_BLANKS.finditer(text), None]:
        stop = run.start() if run else len(text)
        while at < stop:
            cut = CUT.search(text, at + limit, stop) if stop - at > limit else None
            end = cut.start() if cut else stop
            yield text[at:end], False
            at = end
        if run:
            at = run.end() if run.end() == len(text) else run.end() - 1  # the last blank may belong to the next word
            yield text[stop:at], True


class TextEncoder:
    """Encodes whole texts and decodes ids with one set of ranks; made once per task."""

    def __init__(self, rank_file: str, pattern: str, limit: int = SEGMENT_CHARS):
        import tiktoken

        ranks = read_ranks(rank_file)
        self.split = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.one_match = tiktoken.Encoding("run", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.limit = limit

    def encode(self, text: str | None) -> np.ndarray:
        parts = [(self.one_match if whole else self.split).encode_to_numpy(segment)
                 for segment, whole in cut_long_text(text or "", self.limit)]
        return (np.concatenate(parts) if parts else np.zeros(0)).astype(np.int32)

    def decode(self, ids) -> bytes:
        return self.split.decode_bytes(ids)


def _lists(column: pa.ListArray) -> Iterator[list[int]]:
    """Values of a list column, null as empty; slices of the flat values, far faster than element by element."""
    values, offsets = column.values.to_numpy(), column.offsets.to_numpy()
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for i in range(len(column)):
        yield values[offsets[i]:offsets[i + 1]].tolist() if valid[i] else []


def _batches(column: Iterable, work, size) -> Iterator[tuple[int, int, list]]:
    """``(first row, rows, results)`` with about ``FLUSH`` units a batch, so that long rows do not pile up."""
    first, done, held = 0, [], 0
    for i, value in enumerate(column):
        done.append(work(value))
        held += size(done[-1])
        if held >= FLUSH:
            yield first, len(done), done
            first, done, held = i + 1, [], 0
    if done:
        yield first, len(done), done


def _with_column(df: DataFrame, name: str, kind, keep: list[str] | None) -> tuple[list[str], StructType]:
    names = [c for c in (df.columns if keep is None else keep) if c.lower() != name.lower()]
    return names, StructType([*(df.schema[c] for c in names), StructField(name, kind, False)])


def encode_texts(docs: DataFrame, rank_file: str, pattern: str, text_col: str = "text", ids_col: str = "ids",
                 keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``ids_col``, the ids of the whole text as ``array<int>``.

    One pass without a shuffle. ``rank_file`` is a path every executor can read; no special tokens are used, their
    spellings are ordinary text. A null or empty text has no ids (empty array). Rows, repeated ones too, are encoded
    one by one, extra columns pass through, a column already named ``ids_col`` is replaced, and an empty table gives
    an empty result.
    """
    names, schema = _with_column(docs, ids_col, ArrayType(IntegerType(), False), keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(rank_file, pattern)
        for batch in batches:
            for at, n, ids in _batches(batch.column(text_col), lambda v: encoder.encode(v.as_py()), len):
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
                part = batch.slice(at, n)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), column], [*names, ids_col])

    return docs.select(*dict.fromkeys([*names, text_col])).mapInArrow(run, schema)


def decode_ids(rows: DataFrame, rank_file: str, pattern: str, ids_col: str = "ids", bytes_col: str = "decoded",
               keep: list[str] | None = None) -> DataFrame:
    """``rows`` (or its columns ``keep``) with ``bytes_col``, the raw bytes of the ids (null ids: no bytes)."""
    names, schema = _with_column(rows, bytes_col, BinaryType(), keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(rank_file, pattern)
        for batch in batches:
            for at, n, found in _batches(_lists(batch.column(ids_col)), encoder.decode, len):
                part = batch.slice(at, n)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array(found, pa.binary())], [*names, bytes_col])

    return rows.select(*dict.fromkeys([*names, ids_col])).mapInArrow(run, schema)
