"""Helpers shared by the operators: word pattern, scratch tables, row identity, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import checkpoint_dir

#: ASCII white space: a word is a maximal run of anything else.
SPACE_CLASS = r"[\x20\x09-\x0D]"
_SPACES = " \t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    """Array of the words of a text (null text: empty array). Built-in functions only."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def word_count(text: Column) -> Column:
    """Number of words of a text as BIGINT (null text: 0)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACES))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACE_CLASS + "+"))).cast("bigint")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often ``body`` names it in a lambda."""
    return F.transform(F.array(value), body)[0]


def content_key(*cols: Column) -> Column:
    """128-bit digest of column values as 16 bytes; nulls and the column borders are part of it."""
    parts = []
    for c in cols:
        s = c.cast("string")
        parts.append(F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return F.unhex(F.md5(F.concat(*parts)))


class Scratch:
    """Tables written under the shared folder ``spark.checkpoint.dir`` to cut lineage.

    A written table survives the loss of any executor; a lazy result that is
    read from it needs it, so only tables that a later step has replaced are
    dropped (:meth:`drop`).
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and return the reread table (same schema)."""
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        path = getattr(df, "_scratch_path", None)
        if path:
            jvm = self.spark._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


FILTER_BITS = 1 << 24  # a bitmap of 2 MB whatever the input


def maybe_in(rows: DataFrame, nodes: DataFrame, col: str) -> DataFrame:
    """Rows whose hashed BIGINT ``col`` may be in ``nodes``: all that are, and a few others.

    The filter is a bitmap of ``FILTER_BITS`` bits over the lowest bits of the hash: its size is fixed, so it may be
    broadcast. It keeps wide rows out of the shuffle of the exact join that follows.
    """
    def slot(c: Column) -> Column:
        return F.pmod(c, F.lit(FILTER_BITS))

    bits = nodes.groupBy(F.floor(slot(F.col(col)) / 32768).alias("_block")).agg(
        F.bitmap_construct_agg(slot(F.col(col)) % 32768).alias("_bits"))
    place = slot(F.col(col)) % 32768
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = rows.withColumn("_row_block", F.floor(slot(F.col(col)) / 32768)).join(
        F.broadcast(bits), F.col("_row_block") == F.col("_block"))
    return found.where(F.floor(byte / F.pow(F.lit(2), place % 8)) % 2 == 1).select(*rows.columns)


# the grouped pivots of link_buckets: when buckets are dealt, size of a group, deals a round
PAIRS_A_MEMBER, GROUP, DEALS = 16, 16, 4


def connected_components(edges: DataFrame, a: str, b: str, scratch: Scratch) -> DataFrame:
    """Distributed connected components: ``(node, component)`` for every node of an edge, component = smallest node.

    Alternating large-star and small-star steps until the edge set no longer
    changes. Every step is a partial aggregate (the least neighbour of a node)
    and an equi-join back, so a node with very many links is combined before
    the shuffle and its join partition can be split. Each round is written to
    the shared folder and the round before it dropped. Null ends and loops are
    ignored; no edges give an empty result.
    """
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct())
    e = scratch.table(e, "edges")
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        down = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = scratch.table(down.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "stars")
        scratch.drop(e)
        e = nxt
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def bucket_pivots(members: DataFrame, keys: list[str], node: str) -> DataFrame:
    """``keys, x, p``: the members (BIGINT ``node``, as ``x``) of buckets with two or more, and the bucket's pivot.

    The pivot is a hash-chosen member that differs from bucket to bucket. Sizes are partial aggregates joined back, so a
    hot bucket is combined before the shuffle and its join partition can be split.
    """
    mark = F.xxhash64(*keys)  # node XOR mark: an order of the nodes that differs from bucket to bucket
    marked = F.col(node).bitwiseXOR(mark)
    several = members.groupBy(*keys).agg(F.min(marked).alias("_lo"), F.max(marked).alias("_hi")).where("_lo != _hi")
    several = several.select(*keys, F.col("_lo").bitwiseXOR(mark).alias("p"))
    return members.join(several, keys).select(*keys, F.col(node).alias("x"), "p")


def link_buckets(shared: DataFrame, keys: list[str], near, scratch: Scratch, verify=None,
                 info: DataFrame | None = None) -> DataFrame:
    """``(node, component)`` of the nodes that share a bucket and link, without pairing members of one component.

    ``shared`` is a written table of (bucket ``keys``, node ``x``, pivot ``p``). ``near(a, b)`` is a condition over columns ``a, b``
    (nodes) and ``a_<c>, b_<c>`` for the columns of ``info`` (one row per node ``x``) that holds for every pair that links;
    ``verify(pairs)`` keeps of distinct rows ``(a, b)`` those that truly link (None: the condition is exact). Steps:

    1. every member of a bucket is held against its pivot; links are joined into components. Linear in the members;
    2. while the buckets that still hold several components would take more than ``PAIRS_A_MEMBER`` comparisons a
       member, their members are dealt into groups of about ``GROUP``, ``DEALS`` times, and held against the pivots of their
       groups; again if that spared a quarter of the comparisons or more. Linear in the members: components with many
       links between them are joined by one of them;
    3. in the buckets left open, members outside the largest component are held against the members of other
       components, each pair in the first bucket it shares. A bucket of n linked members and one stranger takes n comparisons;
       n members that do not link take n * n / 2, inside the join, where only pairs that pass ``near`` become rows. The
       join's partitions are split when they are skewed.

    No bucket is capped and no candidate dropped: each pair of a bucket is held against ``near``, or both ends are
    already joined. Returns the nodes with a link.
    """
    def described(df: DataFrame, side: str) -> DataFrame:
        if info is None:
            return df
        cols = [c for c in info.columns if c != "x"]
        return df.join(info.select(F.col("x").alias(f"_{side}"), *[F.col(c).alias(f"{side}_{c}") for c in cols]),
                       F.col(side) == F.col(f"_{side}")).drop(f"_{side}")

    def linked(pairs: DataFrame) -> DataFrame:
        return scratch.table(pairs if verify is None else verify(pairs).select("a", "b"), "links")

    stars = shared.where("x != p").select(F.least("x", "p").alias("a"), F.greatest("x", "p").alias("b")).distinct()
    tried = scratch.table(described(described(stars, "a"), "b").where(near("a", "b")).select("a", "b"), "stars")
    comp = scratch.table(connected_components(linked(tried), "a", "b", scratch), "components")
    bucket, before = F.struct(*keys) if len(keys) > 1 else F.col(keys[0]), None
    while True:
        known = shared.select(*keys, "x").join(comp.withColumnRenamed("node", "x"), "x", "left").select(
            *keys, "x", F.coalesce("component", "x").alias("c"))
        parts = scratch.table(known.groupBy(*keys, "c").agg(F.count(F.lit(1)).alias("n")), "parts")
        open_ = parts.groupBy(*keys).agg(F.count(F.lit(1)).alias("cs"), F.max(F.struct("n", "c")).alias("most"),
                                         F.sum("n").alias("size")).where("cs > 1")
        open_ = scratch.table(open_.select(*keys, F.col("most.c").alias("main"), F.col("most.n").alias("in_main"), "size"), "buckets")
        rest = known.join(open_, keys)
        out = F.col("size") - F.col("in_main")
        pairs, members = open_.agg(F.sum((out * F.col("in_main") + out * out / 2).cast("double")),
                                   F.sum("size").cast("double")).first()
        if not members or pairs <= PAIRS_A_MEMBER * members or before and pairs > 0.75 * before:
            break
        before = pairs
        dealt = rest.select(*keys, "x", "c", "size", F.explode(F.array(*[F.lit(k) for k in range(DEALS)])).alias("deal"))
        # the count of pairs falls from round to round, so no round repeats the deals of another
        dealt = dealt.withColumn("mark", F.xxhash64(*keys, "x", "deal", F.lit(pairs))).withColumn(
            "group", F.pmod(F.xxhash64("mark"), F.ceil(F.col("size") / GROUP)))
        group = [*keys, "deal", "group"]
        pivots = dealt.groupBy(*group).agg(F.min(F.struct("mark", "x", "c")).alias("p"))
        held = dealt.join(pivots, group).where("c != p.c").select(
            F.least("x", "p.x").alias("a"), F.greatest("x", "p.x").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
        held = scratch.table(described(described(held, "a"), "b").where(near("a", "b")).select("a", "b"), "dealt")
        comp = scratch.table(_joined(comp, linked(held), scratch), "components")
        tried = tried.unionByName(held)
    at = rest.groupBy("x").agg(F.collect_set(bucket).alias("at")).select(F.col("x").alias("at_x"), "at")
    rest = scratch.table(rest.join(at, F.col("x") == F.col("at_x")).select(*keys, "x", "c", "main", "at"), "open")
    left = described(rest.where("c != main").select(*[F.col(k).alias(f"l_{k}") for k in keys], F.col("x").alias("a"),
                                                    F.col("c").alias("ca"), F.col("at").alias("at_a")), "a")
    right = described(rest.select(*keys, F.col("x").alias("b"), F.col("c").alias("cb"), "main", F.col("at").alias("at_b")), "b")
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(f"l_{k}") == F.col(k))
    cross = left.join(right, same & (F.col("ca") != F.col("cb")) & ((F.col("cb") == F.col("main")) | (F.col("a") < F.col("b")))
                      & near("a", "b") & (F.array_min(F.array_intersect("at_a", "at_b")) == bucket))
    cross = cross.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(
        tried, ["a", "b"], "left_anti")  # those are checked
    return _joined(comp, linked(cross), scratch)


def _joined(comp: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """Components ``(node, component)`` after some more ``links`` (a written table ``a, b``): only the components that
    they touch are joined anew, as nodes of a smaller graph."""
    ends = links
    for c in ("a", "b"):
        ends = ends.join(comp.select(F.col("node").alias(f"_{c}"), F.col("component").alias(f"c{c}")),
                         F.col(c) == F.col(f"_{c}"), "left").withColumn(f"c{c}", F.coalesce(f"c{c}", c))
    moved = connected_components(ends.select("ca", "cb"), "ca", "cb", scratch).select(
        F.col("node").alias("was"), F.col("component").alias("now"))
    # a node without a component yet is one of its own
    alone = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(comp.select("node"), "node", "left_anti")
    every = comp.unionByName(alone.select("node", F.col("node").alias("component")))
    return every.join(moved, F.col("component") == F.col("was"), "left").select(
        "node", F.coalesce("now", "component").alias("component"))
