"""Word-list membership (PRJ17) over tokenised text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

__all__ = ["flag_words", "keep_flagged"]


def _listed(words: DataFrame, word_col: str) -> DataFrame:
    return words.select(F.col(word_col).alias("_w")).where(F.col("_w") != "").distinct()


def flag_words(df: DataFrame, key: str, tokens_col: str, words: DataFrame, word_col: str = "word") -> DataFrame:
    """Per row: its ``key``, ``is_sensitive`` (any token in the list) and ``hit_count`` (tokens in the list).

    One row out per row in, also for equal and null keys: rows are told apart by their place in the input. Tokens are
    exploded and matched against the word list (an equi-join); the per-row count is a partial aggregate. Rows with no
    tokens or no hits get ``False``/0; an empty token list is ``False`` as in the source check.
    """
    w = _listed(words, word_col)
    toks = df.select(key, tokens_col, F.monotonically_increasing_id().alias("_row"))
    toks = toks.select("_row", key, F.explode_outer(tokens_col).alias("_t"))
    hits = toks.join(w, toks["_t"] == w["_w"], "left")
    return (hits.groupBy("_row", key)
            .agg(F.count("_w").cast("bigint").alias("hit_count"))
            .select(key, (F.col("hit_count") > 0).alias("is_sensitive"), "hit_count"))


def keep_flagged(df: DataFrame, key: str, tokens_col: str, words: DataFrame, word_col: str = "word") -> DataFrame:
    """Rows with at least one listed token (a left-semi join on the exploded tokens; ``key`` need not be unique).

    A token is matched once per distinct token list: the lists are hashed to 128 bits, and a row is kept if its list is.
    """
    same = F.md5(F.to_json(F.struct(F.col(tokens_col).alias("t"))).cast("binary"))
    toks = df.select(same.alias("_list"), tokens_col).dropDuplicates(["_list"]).select("_list", F.explode(tokens_col).alias("_t"))
    w = _listed(words, word_col)
    flagged = toks.join(w, toks["_t"] == w["_w"], "left_semi").select("_list").distinct()
    return df.withColumn("_of", same).join(flagged, F.col("_of") == F.col("_list"), "left_semi").drop("_of")
