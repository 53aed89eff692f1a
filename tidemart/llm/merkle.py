"""Merkle manifest of a dataset: one tree per group of rows, one tree over the groups' roots, a proof for every row.

Digests travel as 32 bytes; a node's digest is the SHA-256 of its children's digests written as lowercase hex.

1. Every row becomes a leaf digest (one pass over the texts); the digests alone are sorted by range and written.
2. A leaf's place in its group is its index in its written part, plus the rows of the parts before, minus the group's
   first index: no window ever holds a whole group.
3. Per level, lag and lead columns at the fixed offsets 1 to ``fanout`` - 1, masked by the slot in the run and the
   run's length, are the siblings of a node; the first row of a run hashes itself and its leads to the parent. The
   windows cover ``CHUNK_RUNS`` runs, so a hot group spreads over all tasks.
4. The trees are walked from the top: a node's path is its own siblings and the path of its parent.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import Scratch

__all__ = ["digest", "record_digest", "merkle_manifest", "fold_path", "path_digest"]

CHUNK_RUNS = 16
_ROW = (1 << 33) - 1  # bits of monotonically_increasing_id that count the rows of a partition
PATH = "array<struct<left:binary,right:binary>>"


def digest(text: Column) -> Column:
    """SHA-256 of a text or of bytes as 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def _hex(raw: Column) -> Column:
    return F.lower(F.hex(raw))


def record_digest(*fields: Column) -> Column:
    """Digest (32 bytes) of a record: each field as ``-`` if null, else its UTF-8 byte count, ``:`` and its text."""
    parts = [F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
             for s in (f.cast("string") for f in fields)]
    return digest(F.concat(*parts))


def fold_path(leaf: Column, path: Column) -> Column:
    """Root (32 bytes) that a leaf digest and a path of siblings lead to."""
    return F.aggregate(path, leaf, lambda node, s: digest(F.concat(_hex(s["left"]), _hex(node), _hex(s["right"]))))


def path_digest(path: Column) -> Column:
    """Digest (32 bytes) of all siblings of a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: _hex(F.concat(s["left"], s["right"]))), ""))


def _placed(rows: DataFrame, group: str, order: list[str], scratch: Scratch) -> DataFrame:
    """Adds ``g`` (a number per group, ascending with the group's value, null first), ``pos`` (from 0) and ``n``.

    Rows are sorted by range into parts. Small tables only are aggregated: one row per (part, group), one per part.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())  # equal rows may part, no key is too heavy to cut
    parts = rows.repartitionByRange(*keys, F.col("_tie")).sortWithinPartitions(*keys, "_tie").drop("_tie")
    parts = scratch.table(parts.withColumn("_part", F.spark_partition_id()).withColumn(
        "_at", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW))), "sorted")
    spans = parts.groupBy("_part", F.col(group).alias("_group")).agg(F.count(F.lit(1)).alias("c"), F.min("_at").alias("lo"))
    spans = scratch.table(spans, "spans")
    before = spans.groupBy("_part").agg(F.sum("c").alias("c")).select(
        F.col("_part"), (F.sum("c").over(Window.orderBy("_part")) - F.col("c")).alias("before"))
    whole = Window.partitionBy("_group")
    spans = spans.join(before, "_part").select(
        F.col("_part").alias("_p"), "_group", "before", F.min(F.col("before") + F.col("lo")).over(whole).alias("g"),
        F.sum("c").over(whole).alias("n"))
    found = parts.join(spans, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_group")))
    return found.select(*[c for c in parts.columns if c not in ("_part", "_at")], "g",
                        (F.col("before") + F.col("_at") - F.col("g")).alias("pos"), "n")


def _levels(nodes: DataFrame, fanout: int, scratch: Scratch) -> list[DataFrame]:
    """Written tables of the levels, leaves first: ``nodes`` (``g, pos, n, node`` and more at the lowest level) with
    ``left`` and ``right``, the concatenated digests of the run's other nodes. A group ends at the level where n = 1."""
    levels = []
    while True:
        slot, length = F.col("pos") % fanout, F.least(F.lit(fanout), F.col("n") - F.col("pos") + F.col("pos") % fanout)
        spread = F.expr(f"pos div {fanout * CHUNK_RUNS}")
        w = Window.partitionBy("g", spread).orderBy("pos")
        none = F.lit(b"")
        left = F.concat(*[F.when(slot >= k, F.lag("node", k).over(w)).otherwise(none) for k in range(fanout - 1, 0, -1)])
        right = F.concat(*[F.when(slot + k < length, F.lead("node", k).over(w)).otherwise(none) for k in range(1, fanout)])
        level = scratch.table(nodes.select("*", left.alias("left"), right.alias("right")), f"level{len(levels)}")
        levels.append(level)
        if level.where("n > 1").isEmpty():
            return levels
        nodes = level.where((slot == 0) & (F.col("n") > 1)).select(
            "g", F.expr(f"pos div {fanout}").alias("pos"), F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"),
            digest(_hex(F.concat("node", "right"))).alias("node"))


def _tops(levels: list[DataFrame]) -> DataFrame:
    """``g, level, top``: the level at which each group is one node, and that node's digest."""
    ends = [t.where("n = 1").select("g", F.lit(k).alias("level"), F.col("node").alias("top")) for k, t in enumerate(levels)]
    return reduce(DataFrame.unionByName, ends)


def _paths(levels: list[DataFrame], tops: DataFrame, carry: list[str], fanout: int) -> DataFrame:
    """The lowest level with the columns ``carry`` of its group's row in ``tops`` and the whole ``path`` to the root.

    ``tops`` has ``g, level, path`` and ``carry``; its path is the part above the group's own tree.
    """
    above = None
    for k in range(len(levels) - 1, -1, -1):
        up = tops.where(F.col("level") == k).select(
            F.col("g").alias("ug"), F.lit(0).cast("bigint").alias("urun"), *carry, F.col("path").alias("upath"))
        if above is not None:
            up = up.unionByName(above.select(F.col("g").alias("ug"), F.col("pos").alias("urun"), *carry,
                                             F.col("path").alias("upath")))
        joined = levels[k].join(up, (F.col("g") == F.col("ug")) & (F.expr(f"pos div {fanout}") == F.col("urun")))
        own = F.array(F.struct("left", "right")).cast(PATH)
        path = F.when(F.col("n") == 1, F.col("upath")).otherwise(F.concat(own, F.col("upath")))
        above = joined.select(*[c for c in levels[k].columns if c not in ("left", "right")], *carry, path.alias("path"))
    return above


def merkle_manifest(docs: DataFrame, leaf: Column, group_col: str = "source", id_col: str = "doc_id",
                    carry: dict[str, Column] | None = None, fanout: int = 16, scratch: Scratch | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, leaf, subroot, root`` (32 bytes each), ``path`` and the columns ``carry``.

    ``leaf`` gives a row's digest (:func:`record_digest`). Per group the leaves ascend by id; every ``fanout``
    consecutive nodes become the digest of their hex digests, until one is left, the group's ``subroot`` (a lone leaf
    itself). The subroots, in order of the group (null first, then bytewise), form the ``root`` likewise. ``path`` is an
    array of ``left`` and ``right`` siblings (concatenated digests) from the leaf's run up to the root, for
    :func:`fold_path` and :func:`path_digest`. ``carry`` holds further expressions over ``docs`` kept per row.

    Null ids come first in their group; rows of equal id are ordered by their digest, so whole repeated rows have one
    place each. A null text or any other null field is part of the digest. An empty table gives an empty result.

    Only digests are shuffled: by range, by chunk of a group, and by run for the paths; the sources need not fit anywhere.
    """
    scratch = scratch or Scratch(docs.sparkSession, "merkle")
    carry = carry or {}
    extra = {f"_x{i}": c for i, c in enumerate(carry.values())}
    leaves = scratch.table(docs.select(F.col(group_col).alias("_grp"), F.col(id_col).alias("_id"), leaf.alias("node"),
                                       *[c.alias(k) for k, c in extra.items()]), "leaves")
    placed = _placed(leaves, "_grp", ["_id", "node"], scratch).drop("_grp")
    lower = _levels(placed, fanout, scratch)
    tops = scratch.table(_tops(lower), "subroots")
    over = _placed(tops.select(F.lit(0).alias("_all"), F.col("g").alias("group"), F.col("top").alias("node")),
                   "_all", ["group"], scratch).drop("_all")
    upper = _levels(over, fanout, scratch)
    ends = _tops(upper).select("g", "level", F.col("top").alias("root"), F.array().cast(PATH).alias("path"))
    roots = _paths(upper, ends, ["root"], fanout).select(F.col("group").alias("rg"), "root", "path")
    tops = scratch.table(tops.join(roots, F.col("g") == F.col("rg")).select(
        "g", "level", F.col("top").alias("subroot"), "root", "path"), "roots")
    out = _paths(lower, tops, ["subroot", "root"], fanout)
    return out.select(F.col("_id").alias(id_col), F.col("node").alias("leaf"), "subroot", "root", "path",
                      *[F.col(k).alias(name) for k, name in zip(extra, carry, strict=True)])
