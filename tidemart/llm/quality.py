"""Quality rules by cross-document line frequency (native: built-in functions only).

Lines are normalised and hashed; for every (host, line) the distinct documents holding it are counted. A line in more
documents of its host than the limits allow is boilerplate and is removed; a document that loses too large a share of
its words is depleted and rejected. Exact copies of a text count as one document of a host, so that a popular
document does not make its own lines boilerplate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import Scratch, content_key, let, word_count, words_of

__all__ = ["quality_rules", "normalised_line", "repeated_window_words", "drop_boilerplate"]

SYMBOLS = "[#*$%&|<>]"


def normalised_line(line: Column) -> Column:
    """Lower case, digits as 0, white space runs as one space, none at the ends."""
    squeezed = F.btrim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "))
    return F.regexp_replace(F.lower(squeezed), "[0-9]", "0")


def _line_hash(line: Column) -> Column:
    return F.xxhash64(normalised_line(line))


def repeated_window_words(words: Column) -> Column:
    """Number of words that lie in a 3-word window found twice or more in ``words`` (first finding included).

    Windows are sorted by (32-bit hash, place) packed in one number, so that equal windows become neighbours; the few
    places whose hash has an equal neighbour are compared again by their words, which makes the count exact.
    """
    def packed(w: Column) -> Column:
        return F.sort_array(F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.shiftleft(F.hash(w[i], w[i + 1], w[i + 2]).cast("bigint"), 32).bitwiseOR(i.cast("bigint"))))

    def neighbours(s: Column, same) -> Column:
        n = F.size(s)
        return F.filter(s, lambda x, j: ((j > 0) & same(F.get(s, j - 1), x))
                        | ((j < n - 1) & same(F.get(s, j + 1), x)))

    def high(x: Column) -> Column:
        return F.shiftright(x, 32)

    def exact(w: Column, candidates: Column) -> Column:
        places = F.transform(candidates, lambda x: x.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))
        return F.sort_array(F.transform(places, lambda i: F.struct(
            F.concat_ws(" ", w[i], w[i + 1], w[i + 2]).alias("t"), i.alias("i"))))

    def covered(found: Column) -> Column:
        return F.size(F.array_distinct(F.flatten(F.transform(
            found, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    def count(w: Column) -> Column:
        candidates = let(packed(w), lambda s: neighbours(s, lambda a, b: high(a) == high(b)))
        found = let(exact(w, candidates), lambda s: neighbours(s, lambda a, b: a["t"] == b["t"]))
        return F.when(F.size(w) < 4, F.lit(0)).otherwise(covered(found))

    return let(words, count).cast("bigint")


def _measured(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), text.alias("text"),
                    content_key(text).alias("content"), words_of(text).alias("words"), lines.alias("lines"))
    return d.select(
        "doc_id", "host", "content", F.size("words").cast("bigint").alias("n_words"),
        F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        repeated_window_words(F.col("words")).alias("n_repeat_words"),
        F.transform("lines", lambda x: F.struct(_line_hash(x).alias("line"), word_count(x).alias("n"))).alias("lines"))


def _boilerplate(measured: DataFrame, max_docs: int, max_share: float) -> tuple[DataFrame, DataFrame]:
    """``(lines, frequent)``: one row per line of each distinct (host, text), and the (host, line) above the limits."""
    texts = measured.groupBy("host", "content").agg(F.first("lines").alias("lines"))
    lines = texts.select("host", "content", F.explode("lines").alias("l")).select(
        "host", "content", F.col("l.line").alias("line"), F.col("l.n").alias("n"))
    host_docs = texts.groupBy(F.col("host").alias("h")).agg(F.count(F.lit(1)).alias("host_docs"))
    counts = (lines.select("host", "content", "line").distinct()
              .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") > max_docs))
    frequent = (counts.join(host_docs, F.col("host").eqNullSafe(F.col("h")))
                .where(F.col("n_docs") > max_share * F.col("host_docs")).select("host", "line"))
    return lines, frequent


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  max_docs: int = 50, max_share: float = 0.005, max_removed: float = 0.5, min_words: int = 50,
                  scratch: Scratch | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, host, content, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, removed_words, kept`` (native).

    * ``base_failed``: fewer than ``min_words`` words, or more than half of the words in repeated 3-word windows;
    * a line is removed if more than ``max_docs`` distinct documents of its host hold it, and more than the share
      ``max_share`` of the host's distinct documents;
    * ``kept`` is false if ``base_failed``, or if more than ``max_removed`` of the words were in removed lines.

    Scale: the texts are read once and reduced to hashes; shuffled are (host, document, line) hashes, counted by
    partial aggregates, so a line that a third of all documents share is counted before the shuffle.

    A null text counts as empty (0 words, ``base_failed``); null hosts form a host of their own; null ids are
    allowed; repeated rows each return a row with the same values. Blank lines are never boilerplate. An empty table
    gives an empty result; extra columns are ignored.
    """
    scratch = scratch or Scratch(docs.sparkSession, "quality")
    measured = scratch.table(_measured(docs, id_col, text_col, host_col), "measured")
    lines, frequent = _boilerplate(measured, max_docs, max_share)
    frequent = scratch.table(frequent, "frequent")
    removed = (lines.join(frequent.select(F.col("host").alias("fh"), F.col("line").alias("fl")),
                          F.col("host").eqNullSafe(F.col("fh")) & (F.col("line") == F.col("fl")))
               .groupBy(F.col("host").alias("rh"), F.col("content").alias("rc"))
               .agg(F.sum("n").alias("removed"), F.collect_set("line").alias("removed_lines")))
    out = measured.drop("lines").join(
        removed, F.col("host").eqNullSafe(F.col("rh")) & (F.col("content") == F.col("rc")), "left")
    out = out.withColumn("removed_words", F.coalesce("removed", F.lit(0)).cast("bigint"))
    out = out.withColumn("base_failed", (F.col("n_words") < min_words)
                         | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    out = out.withColumn("kept", ~F.col("base_failed")
                         & (F.col("removed_words") <= max_removed * F.col("n_words")))
    return out.drop("rh", "rc", "removed")


def drop_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                     **rules) -> DataFrame:
    """Filtering form: the kept rows of ``docs`` with all their columns, boilerplate lines cut from ``text_col``.

    Rows are matched to their verdict by (host, text). See :func:`quality_rules` for parameters and edge cases.
    """
    verdict = quality_rules(docs, id_col, text_col, host_col, **rules).where("kept")
    verdict = verdict.groupBy(F.col("host").alias("_v_host"), F.col("content").alias("_v_content")).agg(
        F.first("removed_lines").alias("_v_lines"))
    cols = docs.columns
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.withColumn("_d_content", content_key(text)).join(
        verdict, F.col(host_col).eqNullSafe(F.col("_v_host")) & (F.col("_d_content") == F.col("_v_content")))
    cut = F.array_join(F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(
        F.col("_v_lines"), _line_hash(x)) | ~x.rlike(r"[^\x20\x09-\x0D]")), "\n")
    new = F.when(F.size(F.coalesce("_v_lines", F.array().cast("array<bigint>"))) == 0, F.col(text_col)).otherwise(cut)
    return rows.withColumn(text_col, new).select(*cols)
