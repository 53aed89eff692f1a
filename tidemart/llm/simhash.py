"""SimHash near-dedup by covering locality-sensitive hashing.

A fingerprint bit says whether most shingles of the text have that bit in their hash. For radius r the 64 bit places
get fixed labels of r + 1 bits, and each of the 2^(r+1) - 1 nonzero vectors v of r + 1 bits defines a mask: the places
whose label has an odd inner product with v. Any r places lie in a proper subspace, so some v is orthogonal to all
their labels: its mask leaves out every place where two fingerprints within the radius differ, and they agree under
it. Every such pair therefore meets in some table; nothing is left to chance.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import Scratch, bucket_pivots, link_buckets

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["fingerprints", "covering_masks", "simhash_components", "simhash_near_dedup", "drop_near_copies"]

BITS = 64


def fingerprint(text: str | None, shingle_words: int) -> int:
    """64-bit SimHash of one text; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle_words, len(words))
    spans = zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)
    hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in spans], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        ones += np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
                              ).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle_words: int = 4, text_col: str = "text", out_col: str = "fp",
                 carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns plus the fingerprint as a signed BIGINT; one pass over the texts, no shuffle."""
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series(np.array([fingerprint(t, shingle_words) for t in texts], np.uint64).view(np.int64))

    return docs.select(*carry, F.pandas_udf(run, "bigint")(F.col(text_col)).alias(out_col))


def covering_masks(radius: int) -> list[int]:
    """Masks (signed 64-bit) of the covering tables for ``radius``: 2^(radius+1) - 1 of them.

    Place i gets the label 1 + i mod (2^(radius+1) - 1): all nonzero labels, as evenly as 64 places allow, so that
    every mask keeps about half of the places.
    """
    if not 0 <= radius <= 5:
        raise ValueError("radius must be from 0 to 5")
    n = 2 ** (radius + 1)
    masks = []
    for v in range(1, n):
        mask = sum(1 << i for i in range(BITS) if ((1 + i % (n - 1)) & v).bit_count() % 2)
        masks.append(mask - (1 << BITS) if mask >> (BITS - 1) else mask)
    return masks


def simhash_components(fps: DataFrame, radius: int, scratch: Scratch, fp_col: str = "fp") -> DataFrame:
    """``(node, component)`` for fingerprints that have another one within ``radius`` bits."""
    distinct = fps.select(F.col(fp_col).alias("x")).distinct()
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("x").bitwiseAND(F.lit(m)).alias("k"))
                       for t, m in enumerate(covering_masks(radius))])
    members = distinct.select("x", F.explode(tables).alias("e")).select("x", "e.t", "e.k")
    shared = scratch.table(bucket_pivots(members, ["t", "k"], "x"), "shared")
    return link_buckets(shared, ["t", "k"], lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= radius, scratch)


def simhash_near_dedup(docs: DataFrame, shingle_words: int = 4, radius: int = 4, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id``: one row per row of ``docs``.

    Fingerprints link at ``radius`` or fewer differing bits; ``component_id`` is the smallest id reachable. Texts of
    equal fingerprint are one node, so exact copies cost one row however many there are. Texts without words have
    fingerprint zero and link like any other.

    Null texts count as texts without words; a null id is never the smallest unless its component has no other (then
    null); repeated rows each return a row. Empty table: empty result. Extra columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    fps = scratch.table(fingerprints(docs.withColumnRenamed(id_col, "doc_id") if id_col != "doc_id" else docs,
                                     shingle_words, text_col), "fingerprints")
    comp = scratch.table(simhash_components(fps, radius, scratch), "components")
    ids = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    by_fp = ids.join(comp, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("component", "fp").alias("c"), "least")
    by_comp = by_fp.groupBy("c").agg(F.min("least").alias("component_id"))
    names = by_fp.select("fp", "c").join(by_comp, "c").select(F.col("fp").alias("f"), "component_id")
    return fps.join(names, F.col("fp") == F.col("f")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, shingle_words: int = 4, radius: int = 4, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Filtering form: one row of each component, the one with the smallest id (null ids last), all columns kept.

    Rows of equal id and component are told apart by a digest of all their columns; among fully equal rows one stays.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    cols = docs.columns
    row = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in cols], F.lit(1))
    order = F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("i"), row.alias("h"))
    fps = scratch.table(fingerprints(docs.select(order.alias("o"), F.col(text_col).alias("text")), shingle_words,
                                     "text", carry=("o",)), "fingerprints")
    comp = simhash_components(fps, radius, scratch)
    best = fps.groupBy("fp").agg(F.min("o").alias("o"))
    best = best.join(comp, F.col("fp") == F.col("node"), "left").groupBy(
        F.coalesce("component", "fp").alias("c")).agg(F.min("o").alias("o"))
    counts = fps.groupBy("o").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("o", "w")
    winners = scratch.table(best.join(counts, F.col("o") == F.col("w")).select(
        F.col("o.i").alias("_w_id"), F.col("o.h").alias("_w_hash"), F.col("n").alias("_w_n")), "winners")
    kept = docs.withColumn("_d_hash", row).join(
        winners, F.col(id_col).eqNullSafe(F.col("_w_id")) & (F.col("_d_hash") == F.col("_w_hash")))
    once = kept.where("_w_n = 1").select(*cols)
    return once.unionByName(kept.where("_w_n > 1").select(*cols).dropDuplicates())
