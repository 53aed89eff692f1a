"""Mixing sources to target weights: Efraimidis-Spirakis sampling to token budgets.

Each document gets the key ``-ln(U) / w``: ``U`` is a uniform number from a digest of the seed, the id and the text,
``w`` a quality weight of the text, so better documents come earlier in the order of keys. Within a source the sizes
are prefix-summed in that order up to the source's budget. A source whose target exceeds its size is first repeated
in whole epochs; only the rest of the target is a fractional selection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import Scratch, content_key, word_count

__all__ = ["mix_sources", "mixed_documents", "quality_weight", "source_targets"]

UNIFORM_HEX = 13  # 52 bits of a digest: exact in a double


def quality_weight(text: Column) -> Column:
    """Weight 0.1 to 1.0: the share of letters among the characters that are not white space (no such character: 1)."""
    solid = F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]", ""))
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    return F.when(F.coalesce(solid, F.lit(0)) > 0, 0.1 + 0.9 * letters / solid).otherwise(F.lit(1.0))


def source_targets(totals: DataFrame, weights: list[int], max_epochs: int) -> DataFrame:
    """``(source, source_size, ...)`` -> plus ``target``: weighted shares of all sizes, each at most
    ``max_epochs`` times its source, what exceeds that being shared again by weight.

    The repeated sharing has a closed form: with sources in the order of ``source_size / weight``, those up to some
    place stop at their limit and all later ones get one common level times their weight. One row per source goes
    through one task here: the list of sources is the mixture's recipe, not data.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    t = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (
        (F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).cast("bigint"))
    t = t.withColumn("limit", (F.col("source_size") * max_epochs).cast("bigint"))
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    t = (t.withColumn("total", F.sum("source_size").over(everything))
         .withColumn("full_before", F.coalesce(F.sum("limit").over(
             order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("weight_from", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))))
    t = t.withColumn("level", (F.col("total") - F.col("full_before")) / F.col("weight_from"))
    t = t.withColumn("common", F.min(F.when(
        F.col("level") * F.col("weight") <= F.col("limit"), F.struct(F.col("limit") / F.col("weight"), "level"))
    ).over(everything)["level"])
    return t.withColumn("target", F.least(F.col("common") * F.col("weight"), F.col("limit").cast("double")))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: str = "mix-1",
                carry: tuple[str, ...] = ()) -> DataFrame:
    """``id, source, size, source_size, target, weight, sample_key, epochs, taken`` per row of ``docs`` (native).

    ``taken`` is ``epochs`` times the size, plus the size once more if the row is in the fractional selection: rows
    in the order of their key as long as at least half of a row still fits the budget, so a source misses its
    target by less than half of one document.

    Scale: rows are cut into about sqrt(n) ranges of the key per source; sums of the ranges decide all rows but
    those of the one range where the budget ends, and only that range is sorted. A source with a third of all rows
    is thus spread over many tasks.

    Nulls: text null or empty has size 0 and takes 0; a null source is a source of its own, last in order; null ids
    are allowed. Repeated rows are sampled one by one (equal rows tie; which of them is taken makes no difference).
    Empty table: empty result. Extra columns are ignored unless named in ``carry``.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    text = F.col(text_col)
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit("|"),
                            F.coalesce(text, F.lit(""))))
    uniform = (F.conv(F.substring(digest, 1, UNIFORM_HEX), 16, 10).cast("double") + 1) / float(16 ** UNIFORM_HEX + 1)
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       word_count(text).alias("size"), quality_weight(text).alias("weight"),
                       uniform.alias("uniform"), *[F.col(c).alias(f"carry_{c}") for c in carry])
    base = scratch.table(base.withColumn("sample_key", -F.log("uniform") / F.col("weight")).drop("uniform"), "sizes")

    totals = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    plan = source_targets(totals, list(weights), max_epochs)
    plan = plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.least(
        F.floor(F.col("target") / F.col("source_size")), F.lit(max_epochs))).otherwise(F.lit(0)).cast("bigint"))
    plan = scratch.table(plan.select(
        F.col("source").alias("s"), "source_size", "target", "epochs",
        (F.col("target") - F.col("epochs") * F.col("source_size")).alias("budget"),
        F.ceil(F.sqrt("n")).cast("bigint").alias("ranges")), "targets")

    rows = base.join(plan, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rows = rows.withColumn("range", F.floor((1 - F.exp(-F.col("sample_key"))) * F.col("ranges")))
    sums = rows.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("rs"), F.col("range").alias("rr"), "range_size",
                       F.coalesce(F.sum("range_size").over(before), F.lit(0)).alias("start"))
    rows = rows.join(sums, F.col("source").eqNullSafe(F.col("rs")) & (F.col("range") == F.col("rr"))).drop("rs", "rr")
    inside = F.col("start") + F.col("range_size") <= F.col("budget")
    edge = ~inside & (F.col("start") < F.col("budget"))
    in_range = (Window.partitionBy("source", "range").orderBy("sample_key", F.col("doc_id"), "size")
                .rowsBetween(Window.unboundedPreceding, -1))
    cut = rows.where(edge).withColumn("prefix", F.col("start") + F.coalesce(F.sum("size").over(in_range), F.lit(0)))
    cut = cut.withColumn("extra", (2 * F.col("prefix") + F.col("size") <= 2 * F.col("budget")).cast("bigint"))
    whole = rows.where(~edge).withColumn("extra", inside.cast("bigint"))
    out = cut.drop("prefix").unionByName(whole)
    return out.select("doc_id", "source", "size", "source_size", "target", "weight", "sample_key", "epochs",
                      ((F.col("epochs") + F.col("extra")) * F.col("size")).alias("taken"),
                      *[F.col(f"carry_{c}") for c in carry])


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    **mix) -> DataFrame:
    """The mix itself: rows of ``docs`` with all their columns, each as often as it is taken; rows taken 0 times go,
    but empty documents (size 0) stay once, since they cost nothing.

    Rows are matched to their decision by (id, source, text digest); fully repeated rows share their copies.
    """
    key = content_key(F.col(id_col), F.col(source_col), F.col(text_col))
    mixed = mix_sources(docs.withColumn("_m_key", key), id_col, text_col, source_col, carry=("_m_key",), **mix)
    copies = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(F.lit(1)).cast("bigint")
    each = mixed.groupBy(F.col("carry__m_key").alias("_t_key")).agg(
        F.sum(copies).alias("_t_copies"), F.count(F.lit(1)).alias("_t_rows"))
    rows = docs.withColumn("_d_key", key).join(each.where("_t_copies > 0"), F.col("_d_key") == F.col("_t_key"))
    once = rows.where("_t_rows = 1").select(*docs.columns, "_t_copies")
    several = rows.where("_t_rows > 1").select(*docs.columns, "_t_copies").dropDuplicates()
    out = once.unionByName(several)
    return out.withColumn("_t_copy", F.explode(F.sequence(F.lit(1), F.col("_t_copies").cast("int")))).select(*docs.columns)
