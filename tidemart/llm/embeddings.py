"""Embedding near-dedup: random-hyperplane sign hashing in several tables, exact cosine, connected components.

Vectors whose signs against ``bits`` random hyperplanes agree in some table are compared by their exact cosine in
double precision. Two vectors at cosine c agree in a sign with probability 1 - acos(c)/pi: at 0.98, 14 bits and 16
tables miss a pair with probability 3e-4.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.blocks import block_pairs
from tidemart.llm.common import Scratch, connected_components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["embedding_near_dedup", "hyperplanes"]


BATCH_ROWS = 10_000  # rows of small groups handed to Python together, on average


def hyperplanes(tables: int, bits: int, dim: int, seed: int) -> np.ndarray:
    """Normal vectors of shape (dim, tables * bits)."""
    return np.random.default_rng([seed, dim]).standard_normal((dim, tables * bits))


def _signatures(matrix: np.ndarray, tables: int, bits: int, seed: int) -> np.ndarray:
    signs = matrix @ hyperplanes(tables, bits, matrix.shape[1], seed) > 0
    return (signs.reshape(len(matrix), tables, bits) * (1 << np.arange(bits))).sum(axis=2)


def _sign_keys(tables: int, bits: int, seed: int):
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in parts:
            out = np.zeros((len(vectors), tables), np.int64)
            sizes = np.array([len(v) for v in vectors], np.int64)
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                out[at] = _signatures(np.stack([np.asarray(vectors.iloc[i], np.float64) for i in at]), tables, bits, seed)
            yield pd.Series(list(out))
    return F.pandas_udf(run, "array<bigint>")


def _links(x: np.ndarray, keys: np.ndarray, copies: np.ndarray, blk: np.ndarray, table: int, other_blocks: bool,
           threshold: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links among the rows of one group (unit vectors ``x``): per row the number of vectors it links to here, and the
    edges of a spanning forest. A pair that agrees in an earlier table was counted there and is left out of the counts.
    """
    n = len(x)

    def near(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
        out = (x[rows] @ x[others].T >= threshold) & (rows[:, None] != others[None, :])
        return out & (blk[rows][:, None] != blk[others][None, :]) if other_blocks else out

    counts, linked, all_ = np.zeros(n, np.int64), np.zeros(n, bool), np.arange(n)
    for at in range(0, n, 256):
        rows = all_[at:at + 256]
        link = near(rows, all_)
        linked[rows] = link.any(axis=1)
        if linked[rows].any():
            for t in range(table):
                link &= keys[rows, t][:, None] != keys[None, :, t]
            counts[rows] = link @ copies
    edges, left = [], np.flatnonzero(linked)
    while len(left):  # breadth first over what is not reached yet
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            grown, rest = [], left
            for at in range(0, len(front), 256):
                rows = front[at:at + 256]
                link = near(rows, rest)
                hit = link.any(axis=0)
                edges += zip(rows[link.argmax(axis=0)[hit]].tolist(), rest[hit].tolist(), strict=True)
                grown.append(rest[hit])
                rest = rest[~hit]
            front, left = np.concatenate(grown), rest
    return counts, edges


def _compare(threshold: float):
    """Links of all groups of a batch of groups."""
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        group = frame.groupby(["label", "dim", "t", "k", "bi", "bj"], sort=False).ngroup().to_numpy()
        order = np.argsort(group, kind="stable")
        bounds = [0, *(np.flatnonzero(np.diff(group[order])) + 1).tolist(), len(order)]
        vectors, sign_keys = frame["vector"].array, np.stack(list(frame["sign_keys"])).astype(np.int64)
        node, copies, blk = frame["node"].to_numpy(object), frame["copies"].to_numpy(), frame["blk"].to_numpy()
        table, other_blocks = frame["t"].to_numpy(), frame["bi"].to_numpy() != frame["bj"].to_numpy()
        a, b, links = [], [], []
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            at = order[lo:hi]
            x = np.array([vectors[i] for i in at], np.float64)
            x /= np.abs(x).max(axis=1)[:, None]  # no square overflows or vanishes
            x /= np.sqrt((x * x).sum(axis=1))[:, None]
            counts, edges = _links(x, sign_keys[at], copies[at], blk[at], table[at[0]], other_blocks[at[0]], threshold)
            has = np.flatnonzero(counts)
            a += [*node[at[has]], *(node[at[i]] for i, _ in edges)]
            b += [*[None] * len(has), *(node[at[j]] for _, j in edges)]
            links += [*counts[has].tolist(), *[0] * len(edges)]
        return pd.DataFrame({"a": pd.Series(a, dtype=object), "b": pd.Series(b, dtype=object),
                             "links": pd.Series(links, dtype=np.int64)})
    return run


def embedding_near_dedup(vectors: DataFrame, threshold: float = 0.98, tables: int = 16, bits: int = 14,
                         block_rows: int = 1000, seed: int = 7, id_col: str = "vec_id",
                         vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept``: one row per row of ``vectors``.

    Only vectors of equal, non-null label are compared. Equal vectors of a label are one node that counts with its
    number of rows. Null or zero vectors, null labels and vectors with null or non-finite components link with
    nothing: 0 links, a component of their own, kept. Repeated rows are separate vectors that link with each other.
    A null id is never the smallest of a component that has another id. Empty table: empty result. Vectors of
    different length never link. Extra columns are ignored.

    Scale: a row goes to one bucket per table and label; large buckets are cut into pairs of blocks, whose groups
    reach Python one by one with about twice ``block_rows`` rows at most; smaller buckets come in batches of about
    ``BATCH_ROWS`` rows, however the rows are spread. Groups return counts per vector and a spanning forest, never all
    pairs. At far larger tables raise ``bits`` and ``tables`` together.
    """
    scratch = Scratch(vectors.sparkSession, "embeddings")
    doubles = F.col(vector_col).cast("array<double>")
    base = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), doubles.alias("v"))
    fine = (F.col("v").isNotNull() & F.col("label").isNotNull()
            & F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
            & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False)))
    base = base.withColumn("usable", fine)
    name = F.col("label").cast("string")  # with its length, so that no label runs into the components
    base = base.withColumn("node", F.when(F.col("usable"), F.md5(F.concat_ws(
        ",", F.length(name).cast("string"), name, F.transform("v", lambda x: (x + 0.0).cast("string"))))))
    base = scratch.table(base, "vectors")
    nodes = base.where("usable").groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"), F.first("label").alias("label"),
        F.first("v").alias("vector"))
    nodes = scratch.table(nodes.withColumn("sign_keys", _sign_keys(tables, bits, seed)("vector")), "nodes")
    members = nodes.select("node", "label", "vector", "copies", "sign_keys", F.size("vector").alias("dim"),
                           F.posexplode("sign_keys").alias("t", "k"))
    keys = ["label", "dim", "t", "k"]
    groups = block_pairs(members, keys, F.xxhash64("node", "t"), block_rows)
    # whole buckets are handed to Python in batches, since most are a few rows; together they have no more rows than
    # there are members. A bucket that is cut repeats its rows, so its groups, of full blocks, go one by one.
    batches = max(1, -(-nodes.count() * tables // BATCH_ROWS))
    group = F.xxhash64(*keys, "bi", "bj")
    groups = groups.withColumn("batch", F.when(F.col("blocks") > 1, group).otherwise(F.pmod(group, F.lit(batches))))
    groups = groups.drop("blocks")
    found = scratch.table(groups.groupBy("batch").applyInPandas(
        _compare(threshold), "a string, b string, links bigint"), "found")
    links = found.where("b is null").groupBy(F.col("a").alias("ln")).agg(F.sum("links").alias("links"))
    comp = connected_components(found.where("b is not null"), "a", "b", scratch)
    named = nodes.select("node", "copies", "least").join(links, F.col("node") == F.col("ln"), "left").join(
        comp.withColumnRenamed("node", "cn"), F.col("node") == F.col("cn"), "left")
    named = scratch.table(named.select("node", "least", F.coalesce("component", "node").alias("c"),
                                       (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "named")
    ids = named.groupBy("c").agg(F.min("least").alias("component_id"))
    named = named.join(ids, "c").select(F.col("node").alias("nn"), "n_links", "component_id")
    out = base.join(named, F.col("node") == F.col("nn"), "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                     F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
